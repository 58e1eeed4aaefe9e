"""Sketches within their stated errors, and the radius join on crowds."""

import random

import pytest
from pyspark.sql import functions as F

from panelyard.operators import cohort as H
from panelyard.operators import sketches as S
from panelyard.operators import spatial as X


def test_stored_sketches_of_shards_merge(spark, tmp_path):
    rows = spark.range(60_000).select(
        (F.col("id") % 7).alias("shard"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("label"), F.when(F.col("id") % 50 > 0, F.concat(F.lit("m"), F.pmod(F.xxhash64("id"), F.lit(9000)))).alias("entity"),
        F.when(F.col("id") % 40 == 0, F.lit(float("nan"))).when(F.col("id") % 41 > 0, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10_000)) / 100).alias("x"),
    )
    for k in range(7):  # a shard at a time, as they land
        S.shard_sketches(rows.where(F.col("shard") == k), ("shard", "label"), ("entity",), ("x",)).write.mode("append").parquet(f"{tmp_path}/sketches")
    stored = spark.read.parquet(f"{tmp_path}/sketches")
    assert stored.count() == 14
    quantiles = {"q10": 0.1, "median": 0.5, "q99": 0.99}
    for by in (("label",), ()):
        got = {tuple(r[b] for b in by): r for r in S.estimates(S.merged(stored, by), by, quantiles).collect()}
        fine = rows.where("x IS NOT NULL AND NOT isnan(x)")
        for r in rows.groupBy(*by).agg(F.count("*").alias("n"), F.countDistinct("entity").alias("d")).collect():
            key = tuple(r[b] for b in by)
            assert got[key]["n"] == r["n"] and abs(got[key]["distinct_entity"] / r["d"] - 1) < S.DISTINCT_ERROR
            own = sorted(x["x"] for x in fine.where(F.col("label") == key[0] if by else F.lit(True)).select("x").collect())
            for name, q in quantiles.items():
                v = got[key][f"x_{name}"]
                low, high = sum(x < v for x in own) / len(own), sum(x <= v for x in own) / len(own)
                assert low - S.RANK_ERROR <= q <= high + S.RANK_ERROR
    none = S.estimates(S.shard_sketches(rows.where("label = 'a'").withColumn("x", F.lit(None).cast("double")), ("label",), (), ("x",)), ("label",)).first()
    assert none["x_median"] is None


def test_approximate_composition_and_attrition(spark):
    rng = random.Random(7)
    assays = spark.createDataFrame([(i, f"l{i % 3}", i % 4 > 0) for i in range(40)], "assay_id bigint, label string, admitted boolean")
    activity = spark.createDataFrame([(rng.randrange(42), f"s{rng.randrange(3000)}") for _ in range(9000)], "assay_id bigint, structure string")
    curated = activity.withColumn("value_label", F.pmod(F.xxhash64("structure", "assay_id"), F.lit(8000)) / 1000)
    exact, near = ({r["label"]: r for r in H.composition(assays, activity, curated, a).collect()} for a in (False, True))
    labelled = curated.join(assays, "assay_id", "left").select(F.coalesce("label", F.lit("unknown")).alias("label"), "value_label").collect()
    assert exact.keys() == near.keys() == {"l0", "l1", "l2", "unknown"}
    for k, r in exact.items():
        assert [near[k][c] for c in ("assays", "records", "curated", "assay_pct", "record_pct")] == [r[c] for c in ("assays", "records", "curated", "assay_pct", "record_pct")]
        own = [x["value_label"] for x in labelled if x["label"] == k]
        below, upto = sum(v < near[k]["median"] - 1e-6 for v in own) / len(own), sum(v <= near[k]["median"] + 1e-6 for v in own) / len(own)
        assert below - S.RANK_ERROR <= 0.5 <= upto + S.RANK_ERROR
    one, two = (H.attrition(activity, assays, a).first() for a in (False, True))
    for c in one.asDict():
        assert abs(two[c] - one[c]) <= S.DISTINCT_ERROR * max(one[c], 1e-3) * 1.01 + (0.02 if c == "structure_share" else 0)


@pytest.mark.parametrize("crowd", [4096, 50])
def test_radius_join_by_brute_force_with_crowds(spark, crowd, monkeypatch):
    monkeypatch.setattr(X, "CROWD", crowd)
    rng = random.Random(crowd)
    place = lambda: tuple(rng.choice([rng.uniform(-9, 9), rng.gauss(0, 0.8), float(rng.randint(-3, 3))]) for _ in range(3))
    points = [(i, rng.choice("ab"), *place()) for i in range(700)] + [(1000 + i, "a", 4.0, 4.0, 4.0 + i % 3) for i in range(300)] + [(2000, None, 0.0, 0.0, 0.0), (2001, "a", None, 1.0, 1.0)]
    centers = [(rng.choice("ab"), *place()) for _ in range(40)] + [("a", 6.0, 4.0, 4.0)] * 5 + [(None, 0.0, 0.0, 0.0)]
    got = X.within_radius(spark.createDataFrame(points, "id bigint, entry string, x double, y double, z double"), spark.createDataFrame(centers, "entry string, x double, y double, z double"), 2.0)
    want = [p[0] for p in points if p[1] is not None and None not in p and any(p[1] == c[0] and sum((u - v) ** 2 for u, v in zip(p[2:], c[1:])) <= 4.0 for c in centers)]
    assert sorted(r["id"] for r in got.collect()) == want and got.columns == ["id", "entry", "x", "y", "z"]


def test_a_crowded_cell_is_dealt_to_parts(spark):
    points = spark.range(60_000).selectExpr("'e' AS entry", "id % 97 / 97.0 AS x", "id % 89 / 89.0 AS y", "id % 83 / 83.0 AS z", "id")
    centers = spark.createDataFrame([("e", 2.9, 0.5, 0.5)], "entry string, x double, y double, z double")  # in no cell of a point
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = X.within_radius(points, centers, 2.0)
        sizes = [r["n"] for r in found.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) > 2_000 and max(sizes) < 0.7 * sum(sizes)
