"""Metric records: differences of two, digests, manifests, checksums of landed files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelyard.sources.shared import kept


def metric_diff(a: DataFrame, b: DataFrame, rel_tol: float = 1e-9, path: str = "path", value: str = "value", flag: str | None = None, text: str | None = None, by: tuple[str, ...] = (),
                ignored: tuple[str, ...] = (), ranks: tuple[str, ...] = (), rank_tol: float = 0.0, absolute: bool = False) -> DataFrame:
    """(by, path, kind, gap) where two records differ: missing, extra, null in one, bool, non_finite, or value (texts that differ, a text in one and none in the other, numbers beyond the tolerance).

    flag, text: columns of leaves that are true or false, and of texts. A flag equals the number 1 or 0. by: columns that tell several records apart. ignored: last names of paths that are not
    compared. ranks: last names of paths that are rank statistics and have a tolerance of their own, an absolute one. absolute: the tolerance of the others is one too."""
    def side(df: DataFrame, s: str) -> DataFrame:
        has = lambda n, kind: F.col(n) if n and n in df.columns else F.lit(None).cast(kind)
        return df.select(*by, path, F.col(value).alias(f"v{s}"), has(flag, "boolean").alias(f"f{s}"), has(text, "string").alias(f"t{s}"), F.lit(1).alias(f"i{s}"))

    both = side(a, "a").join(side(b, "b"), [*by, path], "full")
    name = F.element_at(F.split(path, r"\."), -1)
    if ignored:
        both = both.where(~name.isin(*ignored))
    gap = F.abs(F.col("va") - F.col("vb"))
    finite = lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(True))
    flags = F.col("fa").isNotNull() | F.col("fb").isNotNull()
    as_number = lambda s: F.coalesce(F.col(f"f{s}").cast("double"), F.col(f"v{s}"))
    none = lambda s: F.col(f"v{s}").isNull() & F.col(f"t{s}").isNull()
    limit = F.lit(rel_tol) if absolute else rel_tol * F.greatest(F.abs("va"), F.abs("vb"))
    limit = F.when(name.isin(*ranks), rank_tol).otherwise(limit) if ranks else limit
    kind = (
        F.when(F.col("ib").isNull(), "missing").when(F.col("ia").isNull(), "extra").when(flags, F.when(~as_number("a").eqNullSafe(as_number("b")), "bool"))
        .when(none("a") != none("b"), "null").when(~F.col("ta").eqNullSafe(F.col("tb")), "value").when(~finite(F.col("va")) | ~finite(F.col("vb")), "non_finite").when(gap > limit, "value")
    )
    return both.select(*by, path, kind.alias("kind"), F.round(gap, 6).alias("gap")).where("kind IS NOT NULL")


def leaves(records: DataFrame, column: str = "record", by: tuple[str, ...] = ()) -> DataFrame:
    """(by, path, value, flag, text) of nested records: numbers, booleans and texts in a column each, nulls in none. column: JSON texts, or structs, maps and arrays of any depth.

    Paths are names joined by dots with the places of arrays, as in `pairs[0].support.reasons[1]`. Empty objects and arrays have no leaves. Records are unfolded level by level
    by Spark's own VARIANT generator, all records at once; there are as many steps as levels. Each level is a table in the shared folder, so the records are computed once."""
    kind = records.schema[column].dataType
    made = F.parse_json(column) if isinstance(kind, T.StringType) else F.to_variant_object(column)
    now = records.where(F.col(column).isNotNull()).select(*by, F.lit("").alias("path"), made.alias("v"))
    out = None
    while True:
        typed = kept(now.withColumn("kind", F.regexp_extract(F.schema_of_variant("v"), "^[A-Z]+", 0)), "level")
        done = typed.where("kind NOT IN ('OBJECT', 'ARRAY')").select(
            *by, "path", F.when(~F.col("kind").isin("STRING", "BOOLEAN", "VOID"), F.try_variant_get("v", "$", "double")).alias("value"),
            F.when(F.col("kind") == "BOOLEAN", F.try_variant_get("v", "$", "boolean")).alias("flag"), F.when(F.col("kind") == "STRING", F.try_variant_get("v", "$", "string")).alias("text"),
        )
        out = done if out is None else out.unionByName(done)
        inner = typed.where("kind IN ('OBJECT', 'ARRAY')")
        if inner.isEmpty():
            return out
        inner.createOrReplaceTempView(view := f"_level_{uuid.uuid4().hex}")
        names = "".join(f"t.`{c}`, " for c in by)
        step = "CASE WHEN e.key IS NULL THEN concat(t.path, '[', e.pos, ']') WHEN t.path = '' THEN e.key ELSE concat(t.path, '.', e.key) END"
        now = records.sparkSession.sql(f"SELECT {names}{step} AS path, e.value AS v FROM `{view}` AS t, LATERAL variant_explode(t.v) AS e")
        records.sparkSession.catalog.dropTempView(view)


def family_gaps(a: DataFrame, b: DataFrame, path: str = "path", value: str = "value") -> DataFrame:
    """Greatest difference per family (the path's first part)."""
    both = a.select(path, F.col(value).alias("va")).join(b.select(path, F.col(value).alias("vb")), path)
    return both.groupBy(F.substring_index(path, ".", 1).alias("family")).agg(F.count("*").alias("n"), F.round(F.max(F.abs(F.col("va") - F.col("vb"))), 6).alias("max_gap"))


def table_digest(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: rows, and a digest that neither order nor partitioning changes (sums of halves of each row's MD5)."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in columns])
    half = lambda at: F.conv(F.substring(F.md5(text), at, 8), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("n"), F.sum(half(1)).cast("string").alias("high"), F.sum(half(9)).cast("string").alias("low"))


def record_hash(record: DataFrame, path: str = "path", value: str = "value") -> DataFrame:
    """SHA-256 of a (small) metric record as sorted JSON; order of rows does not matter."""
    return record.agg(F.sha2(F.to_json(F.sort_array(F.collect_list(F.struct(path, value)))), 256).alias("sha256"))


def completeness(landed: DataFrame, expected: DataFrame, key: str = "target") -> DataFrame:
    """(key, expected, landed, status): rows that landed against those that the source declared."""
    got = landed.groupBy(key).agg(F.count("*").alias("landed"))
    both = expected.join(got, key, "full")
    status = F.when(F.col("expected").isNull(), "undeclared").when(F.col("landed").isNull(), "absent").when(F.col("landed") == F.col("expected"), "ok").otherwise("mismatch")
    return both.select(key, "expected", F.coalesce("landed", F.lit(0)).alias("landed"), status.alias("status"))


def require_complete(status: DataFrame) -> None:
    bad = status.where("status <> 'ok'").limit(20).collect()
    if bad or status.isEmpty():
        raise ValueError(f"incomplete: {[r.asDict() for r in bad] or 'nothing was declared'}")


def input_identity(manifest: DataFrame, name: str = "file", digest: str = "sha256") -> DataFrame:
    """(name, digests) of inputs that several panels give different digests."""
    return manifest.groupBy(name).agg(F.countDistinct(digest).alias("digests"), F.count("*").alias("entries")).where("digests > 1")


def run_manifest(**parts: DataFrame) -> DataFrame:
    """(section, record as JSON) of all rows of the given small tables."""
    out = None
    for section, df in parts.items():
        rows = df.select(F.lit(section).alias("section"), F.to_json(F.struct(*df.columns)).alias("record"))
        out = rows if out is None else out.unionByName(rows)
    return out


def decisions(verdicts: DataFrame, by: str = "pair") -> DataFrame:
    """Long (path, value, flag, text) table of verdicts, counts and reasons, for an exact `metric_diff`."""
    cols = [(c, t) for c, t in verdicts.dtypes if c != by and t in ("boolean", "bigint", "int", "double", "string")]
    made = [
        F.struct(
            F.lit(c).alias("name"), (F.col(c).cast("double") if t not in ("boolean", "string") else F.lit(None).cast("double")).alias("value"),
            (F.col(c) if t == "boolean" else F.lit(None).cast("boolean")).alias("flag"), (F.col(c) if t == "string" else F.lit(None).cast("string")).alias("text"),
        )
        for c, t in cols
    ]
    return verdicts.select(by, F.explode(F.array(*made)).alias("e")).select(F.concat_ws(".", by, "e.name").alias("path"), "e.value", "e.flag", "e.text")


def panel_manifest(inputs: DataFrame, attrition: DataFrame, gates: DataFrame, settings: dict[str, object] | None = None, by: str = "target") -> DataFrame:
    """(by, record): one nested JSON record a panel, from long tables that each have its name: input files (name, bytes, sha256), attrition steps, gates, and the run's settings, with a digest of
    the inputs. A panel that a table lacks has an empty list there; `passed` is whether it has gates and all of them passed. Panels are few rows each."""
    def listed(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(by).agg(F.sort_array(F.collect_list(F.struct(*[c for c in df.columns if c != by]))).alias(name))

    shas = F.array_join(F.transform("inputs", lambda x: F.concat_ws("  ", x["sha256"], x["name"])), "\n")
    both = listed(inputs.select(by, "name", "bytes", "sha256"), "inputs").join(listed(attrition, "attrition"), by, "full").join(listed(gates, "gates"), by, "full")
    passed = F.coalesce(F.size("gates") > 0, F.lit(False)) & F.coalesce(F.forall("gates", lambda g: F.coalesce(g["passed"], F.lit(False))), F.lit(False))
    parts = [F.col(by), F.coalesce("inputs", F.array()).alias("inputs"), F.sha2(F.coalesce(shas, F.lit("")), 256).alias("inputs_sha256"), F.coalesce("attrition", F.array()).alias("attrition"),
             F.coalesce("gates", F.array()).alias("gates"), passed.alias("passed"), *([F.struct(*[F.lit(v).alias(k) for k, v in sorted(settings.items())]).alias("settings")] if settings else [])]
    return both.select(by, F.to_json(F.struct(*parts)).alias("record"))
