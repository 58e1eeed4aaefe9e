"""Curation of measurements to one robust label per (target, structure), and the wide panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelyard.functions.scalars import is_inactive, is_missing, label_of, to_number, unit_factor

#: Logical columns and the names that inputs may give them.
ALIASES = {"standard_type": "type", "standard_value": "value", "standard_units": "units", "standard_relation": "relation", "pchembl_value": "direct_value",
           "canonical_smiles": "structure", "molecule_chembl_id": "molecule_id", "assay_chembl_id": "assay_id", "target_chembl_id": "target",
           "data_validity_comment": "validity_comment", "document_year": "year"}
NEEDED = ("structure", "molecule_id", "target", "assay_id", "type", "value", "units", "relation", "direct_value", "validity_comment", "activity_comment", "year")
RELATIONS_OK = ("=",)


def standard_header(df: DataFrame) -> DataFrame:
    """Names trimmed, lower-cased, underscored and aliased; the first of equal names stays; needed columns that are absent come as nulls."""
    clean = ["_".join(c.strip().lower().split()) for c in df.columns]
    named = [ALIASES.get(c, c) for c in clean]
    first = {n: i for i, n in reversed(list(enumerate(named)))}
    safe = df.toDF(*[f"_c{i}" for i in range(len(named))])
    kept = [F.col(f"_c{i}").alias(n) for n, i in sorted(first.items(), key=lambda x: x[1])]
    return safe.select(*kept, *[F.lit(None).cast("string").alias(n) for n in NEEDED if n not in first])


def keep_rule(accepted: tuple[str, ...] = ("IC50",), relations: tuple[str, ...] = RELATIONS_OK) -> Column:
    """Accepted type, and a direct value (whatever its relation) or a converted one whose relation is fine or missing."""
    relation = F.col("relation")
    converted = F.col("nm").isNotNull() & (is_missing(relation) | F.trim(relation).isin(*relations))
    return F.lower(F.trim("type")).isin(*[x.lower() for x in accepted]) & (F.col("direct_value").isNotNull() | F.coalesce(converted, F.lit(False)))


def curated_rows(activity: DataFrame, low: float = 3.0, high: float = 11.0) -> DataFrame:
    """Rows that may make a label, with it: flagged and inactive ones dropped, numbers coerced, labels inside [low, high]."""
    rows = activity.where(is_missing(F.col("validity_comment")) & ~is_inactive(F.col("activity_comment")) & F.col("structure").isNotNull())
    rows = rows.withColumns({"direct_value": to_number(F.col("direct_value")), "nm": to_number(F.col("value")) * unit_factor(F.col("units"))})
    return rows.where(keep_rule()).withColumn("label", label_of(F.col("direct_value"), F.col("nm"))).where(F.col("label").between(low, high))


def panel(rows: DataFrame, cutoff: int | None = None) -> DataFrame:
    """One row per (target, structure): median label, count, first id in input order, first and last year, and both eras' medians and counts.

    All in one aggregation. A row without a year is in neither era. first: the first id that is not null.
    """
    pre, post = F.col("year") < cutoff, F.col("year") >= cutoff
    aggs = [F.median("label").alias("label"), F.count("*").alias("n"), F.min_by("molecule_id", F.when(F.col("molecule_id").isNotNull(), F.struct("pos", "molecule_id"))).alias("molecule_id"),
            F.min("year").alias("year"), F.max("year").alias("year_max")]
    if cutoff is not None:
        aggs += [F.median(F.when(pre, F.col("label"))).alias("label_pre"), F.count_if(pre).alias("n_pre"), F.median(F.when(post, F.col("label"))).alias("label_post"), F.count_if(post).alias("n_post"), F.lit(cutoff).alias("cutoff")]
    return rows.groupBy("target", "structure").agg(*aggs)


#: Order of a finished panel's columns; others follow as they are.
OUTPUT = ("target", "molecule_id", "structure", "label", "n", "year", "year_max", "source")


def finished(panel_rows: DataFrame, constants: dict[str, object]) -> DataFrame:
    """A panel with constant columns (which replace columns of their name), the known columns first and in order."""
    rows = panel_rows.withColumns({c: F.lit(v) for c, v in constants.items()}) if constants else panel_rows
    return rows.select([c for c in OUTPUT if c in rows.columns] + [c for c in rows.columns if c not in OUTPUT])


def wide_panel(panel_rows: DataFrame, primary: str, comparators: list[str]) -> DataFrame:
    """A column per target, primary minus each comparator, and the least difference that is not null."""
    wide = panel_rows.groupBy("structure").pivot("target", [primary, *comparators]).agg(F.median("label"))
    wide = wide.withColumns({f"delta_{primary}_{c}": F.col(primary) - F.col(c) for c in comparators})
    deltas = [F.col(f"delta_{primary}_{c}") for c in comparators]
    return wide.withColumn("delta_min", F.least(*deltas) if len(deltas) > 1 else deltas[0])


def counts_by_target(panel_rows: DataFrame) -> DataFrame:
    return panel_rows.groupBy("target").agg(F.count("*").alias("entities"), F.sum("n").alias("measurements"))


def default_primary(panel_rows: DataFrame) -> DataFrame:
    """The target with the most entities, the first by name of equals."""
    return panel_rows.groupBy("target").agg(F.count("*").alias("entities")).orderBy(F.desc("entities"), "target").limit(1)


def training_set(panel_rows: DataFrame, primary: str) -> DataFrame:
    return panel_rows.where(F.col("target") == primary).select("structure", "label", "n")


def violations(table: DataFrame, key: str = "structure", label: str = "label", low: float = 3.0, high: float = 11.0) -> DataFrame:
    """(rule, n) for every rule of the training contract, broken or not."""
    rules = {"key_null": F.col(key).isNull(), "label_null": F.col(label).isNull(), "label_low": F.col(label) < low, "label_high": F.col(label) > high, "key_empty": F.trim(key) == ""}
    one = table.agg(*[F.count_if(c).alias(n) for n, c in rules.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("n")) for n in rules])).alias("v")).select("v.*")


def require_contract(table: DataFrame, **names: str) -> DataFrame:
    """table itself; raises if a rule of `violations` is broken."""
    broken = violations(table, **names).where("n > 0").collect()  # one row per rule
    if broken:
        raise ValueError(f"training set breaks {[(r['rule'], r['n']) for r in broken]}")
    return table


def druglike(df: DataFrame) -> Column:
    """Quality window over descriptor columns; null descriptors fail."""
    ok = F.col("mw").between(150, 650) & F.col("logp").between(-2, 6) & (F.col("hbd") <= 5) & (F.col("hba") <= 10) & (F.col("tpsa") <= 140) & (F.col("rotb") <= 10) & ~F.col("alert")
    return F.coalesce(ok, F.lit(False))


def concat_targets(frames: list[DataFrame]) -> DataFrame:
    """Frames of several targets under each other; columns that one lacks are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def require_known_assays(cohort: str, assays: DataFrame | None) -> None:
    """A cohort other than the unfiltered one needs assay metadata."""
    if cohort != "target_associated" and (assays is None or assays.isEmpty()):
        raise ValueError(f"cohort {cohort!r} needs assay metadata; none is there")
