"""Readers, checks and writers of landed files."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelyard.operators.ranking import smallest
from panelyard.sources.shared import kept

FIELDS = ("molecule_chembl_id", "canonical_smiles", "standard_type", "standard_value", "standard_units", "standard_relation", "pchembl_value", "assay_chembl_id",
          "assay_type", "bao_format", "target_chembl_id", "activity_comment", "data_validity_comment", "document_year", "assay_description")
ASSAY_FIELDS = ("assay_chembl_id", "description", "assay_type", "bao_format", "confidence_score", "assay_organism", "relationship_type")


def read_measurements(spark: SparkSession, path: str, target: str | None = None) -> DataFrame:
    """One target's CSV with all columns as text, as the header names them; target from the argument or the file's name."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path, inferSchema=False)
    name = F.lit(target) if target else F.regexp_extract(F.col("_metadata.file_name"), r"^([^.]+)", 1)
    return df.withColumn("target", name)


def read_assays(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path, inferSchema=False)
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in ASSAY_FIELDS])


def project_fields(df: DataFrame, fields: tuple[str, ...] = FIELDS, types: tuple[str, ...] | None = None, type_column: str = "standard_type") -> DataFrame:
    """Known columns that are there; rows of the wanted types, whatever their case."""
    out = df.select([c for c in fields if c in df.columns])
    return out.where(F.lower(type_column).isin(*[t.lower() for t in types])) if types else out


def _blocks(lines: DataFrame) -> DataFrame:
    return lines.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("at").alias("low"))


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))


def line_index(spark: SparkSession, path: str) -> DataFrame:
    """(file, first, n): where each text file's lines start in the order of the files' names. Small: a row per file. Write it once beside a library that is read in slices."""
    files = spark.read.text(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    return files.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"), "n")


def numbered_lines(spark: SparkSession, path: str, index: DataFrame | None = None, start: int = 0, end: int | None = None) -> DataFrame:
    """(pos, value): all lines of text files, blank ones too, with their number from 0 in the order of the files' names and lines; gzip files are unpacked.

    start, end: only lines from start on, before end. With an index (see `line_index`) only files that hold such lines are read; without one all are counted.
    The lines are a table before they are numbered, so a retried task can't number them otherwise."""
    inside = (F.col("pos") >= start) if end is None else (F.col("pos") >= start) & (F.col("pos") < end)
    if index is not None:
        held = index.where((F.col("first") + F.col("n") > start) & (F.lit(True) if end is None else F.col("first") < end))
        files = [r["file"] for r in held.select("file").collect()]  # names of files, as in any listing
        lines = _lines(spark, files) if files else spark.createDataFrame([], "value string, file string, block bigint, at bigint")
        base = held.select(F.col("file").alias("of"), "first")
    else:
        lines, base = _lines(spark, path), None
    lines = kept(lines, "lines")
    earlier = (Window.partitionBy("file") if base is not None else Window).orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)  # a row per block of a file
    starts = _blocks(lines).select(F.col("file").alias("f"), F.col("block").alias("b"), "low", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    if base is not None:
        starts = starts.join(base, F.col("f") == F.col("of")).select("f", "b", "low", (F.col("start") + F.col("first")).alias("start"))
    both = lines.join(starts, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b")))
    return both.select((F.col("start") + F.col("at") - F.col("low")).alias("pos"), "value").where(inside)


def read_library(spark: SparkSession, path: str, cap: int | None = None, seed: int = 42) -> DataFrame:
    """(pos, key, id) of `key [id]` lines; blank lines count but are skipped, absent ids are row<pos>. cap: so many rows, those with the smallest hashes of seed and place."""
    rows = numbered_lines(spark, path).where("trim(value) <> ''").withColumn("f", F.split(F.trim("value"), r"\s+"))
    rows = rows.select("pos", F.col("f")[0].alias("key"), F.coalesce(F.get("f", F.lit(1)), F.concat(F.lit("row"), "pos")).alias("id"))
    return rows if cap is None else smallest(rows.withColumn("_h", F.xxhash64(F.lit(seed), "pos")), cap, ["_h", "pos"]).drop("_h")


def read_two_columns(spark: SparkSession, path: str, prefix: str, start: int = 0, n: int | None = None, index: DataFrame | None = None) -> DataFrame:
    """(pos, id, key) of two-field lines in either order, from line `start` on, n of them at most; gzip files are unpacked. Lines of fewer fields don't count for n.

    With an index only files from line `start` on are read."""
    rows = two_columns(numbered_lines(spark, path, index, start), prefix, keep=("pos",))
    return rows if n is None else smallest(rows, n, ["pos"])


def two_columns(lines: DataFrame, prefix: str, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """(columns to keep, id, key) of two-field lines in either order: the field with the prefix is the id. Lines of fewer fields are dropped."""
    f = lines.withColumn("f", F.split(F.trim(value), r"\s+")).where("size(f) >= 2")
    first = F.startswith(F.upper(F.col("f")[0]), F.lit(prefix.upper()))
    return f.select(*keep, F.when(first, F.col("f")[0]).otherwise(F.col("f")[1]).alias("id"), F.when(first, F.col("f")[1]).otherwise(F.col("f")[0]).alias("key"))


def read_sums(spark: SparkSession, path: str) -> DataFrame:
    """(name, sha256) of a checksum file: on each line the first 64-hex field, with each other field (folders cut off) as a name; comments and blanks skipped.

    Of several lines with a name the first counts, so a file is found by its name in any field."""
    hexes = "^[0-9a-fA-F]{64}$"
    f = numbered_lines(spark, path).where("NOT startswith(trim(value), '#')").select("pos", F.filter(F.split(F.trim("value"), r"\s+"), lambda x: x != "").alias("f"))
    digest = F.filter("f", lambda x: x.rlike(hexes))
    names = F.transform(F.filter("f", lambda x: ~x.rlike(hexes)), lambda x: F.element_at(F.split(F.ltrim(x, F.lit("*")), "/"), -1))
    rows = f.where(F.size(digest) > 0).select("pos", F.explode(F.array_distinct(names)).alias("name"), F.lower(F.element_at(digest, 1)).alias("sha256"))
    return rows.groupBy("name").agg(F.min_by("sha256", "pos").alias("sha256"))


def verify_pin(spark: SparkSession, path: str, manifest: str | None) -> dict:
    """Whether a library file is the one that its manifest names; raises if the manifest does not name it or names another content."""
    if not manifest:
        return {"verified": False, "why": "no manifest; the library is known by its path only"}
    name = path.rstrip("/").rsplit("/", 1)[-1]
    want = read_sums(spark, manifest).where(F.col("name") == name).first()
    if want is None:
        raise ValueError(f"the manifest has no checksum of {name!r}")
    got = file_digests(spark, path).first()
    if got is None or got["sha256"] != want["sha256"]:
        raise ValueError(f"{name!r} is not the file that the manifest names")
    return {"verified": True, "sha256": got["sha256"], "file": name}


#: Bytes of a file that are held at a time; most tasks that files are dealt to.
PART, TASKS = 1 << 20, 10_000


def stream_digest(stream, gzipped: bool) -> tuple[int, str]:  # noqa: ANN001
    """(bytes, SHA-256) of an open file, read in parts; of what it unpacks to if gzipped, whatever the number of its members."""
    sha, n, unzip = hashlib.sha256(), 0, zlib.decompressobj(31) if gzipped else None
    while raw := stream.read(PART):
        while raw:
            if unzip is None:
                part, raw = raw, b""
            else:
                if unzip.eof:
                    unzip = zlib.decompressobj(31)
                part = unzip.decompress(raw, PART)
                raw = unzip.unused_data if unzip.eof else unzip.unconsumed_tail
            sha.update(part)
            n += len(part)
    if unzip is not None and not unzip.eof and n:
        raise ValueError("a gzip file ends too early")
    return n, sha.hexdigest()


def file_digests(spark: SparkSession, folder: str, glob: str = "*", by_path: bool = False) -> DataFrame:
    """(name, bytes, sha256) of files of any size; gzip files by their decompressed content, under the name without .gz. by_path: the whole path instead of the name.

    Spark lists the files (their names only, empty ones too); a task opens each of its own and reads it in parts, so its memory does not depend on the files' sizes."""
    paths = [unquote(p) for p in spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).inputFiles()]
    files = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, min(len(paths), TASKS)))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for b in batches:
            for path in b.column("path").to_pylist():
                system, place = fs.FileSystem.from_uri(path)
                with system.open_input_stream(place, compression=None) as stream:
                    n, sha = stream_digest(stream, path.endswith(".gz"))
                name = (path if by_path else path.rsplit("/", 1)[-1]).removesuffix(".gz")
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64()), pa.array([sha])], ["name", "bytes", "sha256"])

    return files.mapInArrow(digest, "name string, bytes bigint, sha256 string")


def verify_snapshot(found: DataFrame, sums: DataFrame) -> DataFrame:
    """(name, status): ok, mismatch, missing (listed, not there), unlisted."""
    both = sums.withColumnRenamed("sha256", "want").join(found.select("name", F.col("sha256").alias("got")), "name", "full")
    return both.select("name", F.when(F.col("got").isNull(), "missing").when(F.col("want").isNull(), "unlisted").when(F.col("got") == F.col("want"), "ok").otherwise("mismatch").alias("status"))


def require_verified(status: DataFrame, names: list[str] | None = None) -> None:
    """Raises unless there are files and all (or all the named ones) are ok. Files are counted, and only a few bad ones are read."""
    wanted = status.where(F.col("name").isin(names)) if names else status
    n = wanted.agg(F.count("*").alias("n"), F.countDistinct("name").alias("names")).first()
    bad = wanted.where("status <> 'ok'").limit(20).collect()
    if bad or not n["n"] or (names and n["names"] < len(set(names))):
        raise ValueError(f"snapshot not verified: {[r.asDict() for r in bad] or 'files are missing'}")


def merge_shards(spark: SparkSession, folder: str, glob: str = "*") -> tuple[DataFrame, DataFrame]:
    """(lines with their shard, manifest: name, bytes, sha256, lines), files as they are, gzip ones by their content. The last row, MERGED, pins the whole:
    all bytes and lines, and the SHA-256 of the shards' sums by name."""
    rows = spark.read.option("pathGlobFilter", glob).text(folder).withColumn("shard", F.regexp_replace(F.col("_metadata.file_name"), r"\.gz$", ""))
    counted = rows.groupBy(F.col("shard").alias("name")).agg(F.count("*").alias("lines"))
    shards = file_digests(spark, folder, glob).join(counted, "name", "left").select("name", "bytes", "sha256", F.coalesce("lines", F.lit(0)).alias("lines"))
    sums = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("name", "sha256"))), lambda x: F.concat_ws("  ", x["sha256"], x["name"])), "\n")  # a line per file
    merged = shards.agg(F.sum("bytes").alias("bytes"), F.sha2(sums, 256).alias("sha256"), F.sum("lines").alias("lines")).select(F.lit("MERGED").alias("name"), "bytes", "sha256", "lines")
    return rows, shards.unionByName(merged)


def write_table(df: DataFrame, path: str, form: str = "parquet", by: tuple[str, ...] = ()) -> None:
    w = df.write.mode("overwrite").format(form)
    w = w.partitionBy(*by) if by else w
    (w.option("header", True) if form == "csv" else w).save(path)


def nested(metrics: DataFrame, path: str = "path", value: str = "value") -> DataFrame:
    """One row with a nested JSON record of (path, value) rows; parts of a path are split at dots, keys are sorted. A record is small."""
    def pack(batches):  # noqa: ANN001, ANN202
        import json

        import pandas as pd

        for b in batches:
            for rows in b["rows"]:
                out: dict = {}
                for r in rows:
                    at, keys = out, r["path"].split(".")
                    for k in keys[:-1]:
                        at = at.setdefault(k, {})
                    at[keys[-1]] = None if r["value"] is None or r["value"] != r["value"] else r["value"]
                yield pd.DataFrame({"value": [json.dumps(out, sort_keys=True)]})

    rows = metrics.agg(F.sort_array(F.collect_list(F.struct(F.col(path).alias("path"), F.col(value).cast("double").alias("value")))).alias("rows"))
    return rows.mapInPandas(pack, "value string")


def write_metrics(metrics: DataFrame, path: str) -> None:
    """A (path, value) table as one nested JSON record; any other table as JSON lines with sorted keys."""
    made = nested(metrics) if set(metrics.columns) == {"path", "value"} else metrics.select(F.to_json(F.struct(*sorted(metrics.columns))).alias("value"))
    made.write.mode("overwrite").text(path)
