"""The bit index and the approximate join against brute force: ids of any type, ties, pivots, many bits; and what a search compares."""

import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelyard.operators import bitindex
from panelyard.operators import similarity as N
from panelyard.plans.fixtures import view
from panelyard.sources import shared


def _tables(spark, rng, bits, named=False):
    q, r = [(i, bits(), i % 3) for i in range(60)], [(i, bits(), i % 3, rng.randrange(1, 8)) for i in range(80)]
    r += [(200 + i, q[i][1], q[i][2], 1) for i in range(5)] + [(300 + i, q[i][1], None, 7) for i in range(5)]
    if named:
        q, r = [(f"Q{i}", *x) for i, *x in q], [(f"R{i}", *x) for i, *x in r]
    kind = "string" if named else "bigint"
    make = lambda rows, more="": spark.createDataFrame(rows, f"id {kind}, bits array<int>, apart int{more}").repartition(3)
    return q, r, make(q), make(r, ", sets bigint")


def _ranked(b, g, r, k, other):
    """All references of set k that share a bit, most similar first, smallest id of equals."""
    s = [(-round(len({*b} & {*c}) / len({*b} | {*c}), 9), j) for j, c, h, sets in r if sets >> k & 1 and {*b} & {*c} and not (other and g is not None and g == h)]
    return [(j, -x) for x, j in sorted(s)]


@pytest.mark.parametrize("case", ["few bits", "many bits", "open bits", "pivots", "names"])
def test_best_matches_by_brute_force(spark, case, monkeypatch):
    rng = random.Random(case)
    space = {"many bits": 2048, "open bits": 10**6}.get(case, 200)
    if case == "open bits":
        monkeypatch.setattr(bitindex, "_PACKED", 100)  # in this process; tasks of forked workers see it too
    pool = [rng.sample(range(space), 60) for _ in range(6)]
    bits = lambda: sorted({*rng.sample(rng.choice(pool), rng.choice([0, 1, 3, 10, 30, 55])), *rng.sample(range(space), rng.choice([0, 1, 5]))})
    q, r, qd, rd = _tables(spark, rng, bits, case == "names")
    for other in (False, True):
        make = (lambda d: d) if other else (lambda d: d.withColumn("apart", F.lit(None).cast("int")))
        rows = bitindex.best_matches(make(qd), make(rd), 3, pivots=4 if case == "pivots" else None).collect()
        got = {(x["q"], x["k"]): (x["r"], x["similarity"]) for x in rows}
        assert got == {(i, k): found[0] for i, b, g in q for k in range(3) if (found := _ranked(b, g, r, k, other))}
    few = {}
    for x in sorted(bitindex.best_matches(qd, rd, 2, m=4, pivots=3 if case == "pivots" else 0).collect(), key=lambda x: (-x["similarity"], x["r"])):
        few.setdefault((x["q"], x["k"]), []).append((x["r"], x["similarity"]))
    assert few == {(i, k): found[:4] for i, b, g in q for k in range(2) if (found := _ranked(b, g, r, k, True))}


def test_open_bits_are_compared_without_packing(monkeypatch):
    import numpy as np
    import pyarrow as pa

    rng = random.Random(6)
    sets = [sorted(rng.sample(range(3000), rng.randint(0, 80))) for _ in range(40)]
    a, b = (pa.chunked_array([pa.array(x, pa.list_(pa.int64()))]) for x in (sets, sets[::-1]))
    i, j = (x.reshape(-1) for x in np.meshgrid(range(40), range(40)))
    packed = bitindex._Exact(a, b).shared(i, j)
    monkeypatch.setattr(bitindex, "_PACKED", 10)
    monkeypatch.setattr(bitindex, "_AT_ONCE", 3000)
    plain = bitindex._Exact(a, b)
    assert plain.words is None and (plain.shared(i, j) == packed).all() and plain.compared == 1600
    assert packed.tolist() == [len({*sets[x]} & {*sets[39 - y]}) for x, y in zip(i, j)]


def test_sketches_bound_what_is_shared():
    import numpy as np
    import pyarrow as pa

    rng = random.Random(1)
    sets = [rng.sample(range(4000), rng.randint(1, 400)) for _ in range(50)]
    s = bitindex.sketches(pa.array(sets, pa.list_(pa.int32())))
    most = bitindex.most_shared(s, s)
    assert all(most[i, j] >= len({*a} & {*b}) for i, a in enumerate(sets) for j, b in enumerate(sets))
    small = [rng.sample(range(128), rng.randint(1, 60)) for _ in range(50)]
    s = bitindex.sketches(pa.array(small, pa.list_(pa.int32())))
    assert (bitindex.most_shared(s, s) == np.array([[len({*a} & {*b}) for b in small] for a in small])).all()


def test_a_search_compares_few_pairs(spark):
    b = view(spark, "/root/testdata/sf0.1", "fx_bits").select(F.col("vec_id").alias("id"), "bits", F.lit(None).cast("int").alias("apart"), "train")
    work = bitindex.search_work(b.where("NOT train").drop("train"), b.where("train").drop("train").withColumn("sets", F.lit(1).cast("bigint")))
    assert work["pairs"] > 500_000 and 10 * work["compared"] < work["pairs"]
    # sets of a like size over 2,048 bits, in groups: sketches leave few pairs, pivots skip blocks too
    base = "transform(sequence(1, 40), j -> CAST(pmod(xxhash64(id % 37, j), 2048) AS INT))"
    own = "transform(sequence(1, 12), j -> CAST(pmod(xxhash64(id, j), 2048) AS INT))"
    rows = spark.range(6000).selectExpr("id", f"sort_array(array_distinct(concat({base}, {own}))) AS bits", "CAST(NULL AS INT) AS apart")
    cost = [bitindex.search_work(rows.where("id < 600"), rows.where("id >= 600").withColumn("sets", F.lit(1).cast("bigint")), pivots=p) for p in (0, 37)]
    assert all(10 * c["compared"] < c["pairs"] for c in cost) and cost[1]["bounded"] < cost[0]["bounded"] / 3


def test_nothing_is_left_in_the_shared_folder(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(i, [i % 7, 9, 10 + i % 3]) for i in range(50)], "id bigint, bits array<int>")
    monkeypatch.setattr(shared, "fresh_folder", lambda spark, what: f"file://{tmp_path}/{what}-{uuid.uuid4().hex}")
    N.nearest(rows, rows, "id", "id").collect()
    assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["best"]


def test_approximate_join_finds_most_pairs_and_no_others(spark):
    rng = random.Random(4)
    base = [rng.sample(range(2048), 50) for _ in range(40)]
    sets = [sorted(rng.sample(b, 42) + rng.sample(range(2048), rng.randint(0, 14))) for b in base for _ in range(8)] + [[], [1]]
    df = spark.createDataFrame(list(enumerate(sets)), "id bigint, bits array<int>")
    exact = {(x["q"], x["r"]): x["similarity"] for x in N.threshold_matches(df, df, "id", "id", 0.6).collect()}
    near = {(x["q"], x["r"]): x["similarity"] for x in N.near_matches(df, df, "id", "id", 0.6).collect()}
    assert near.items() <= exact.items() and len(exact) > 1500 and len(near) >= 0.95 * len(exact)


def test_text_bits_of_whole_texts_at_a_linear_cost(spark):
    import time

    text = lambda i: F.substring("text", i, F.lit(3))
    rows = ["", "a", "ab", "abc", "\U0001f600\u00e9b\n\U0001f600x", "\ufeffabcd", None] + [(f"{n}\n\U0001f600\u00e9" * n)[:n] for n in (4095, 4096, 4097, 4098, 4099, 8192, 8193, 9000)]
    df = spark.createDataFrame(list(enumerate(rows)), "id int, text string")
    plain = F.transform(F.sequence(F.lit(1), F.greatest(F.length("text") - 2, F.lit(1))), lambda i: F.pmod(F.xxhash64(text(i)), F.lit(2048)).cast("int"))
    got = df.select("id", N.text_bits(F.col("text")).alias("got"), F.when(F.col("text").isNotNull(), F.sort_array(F.array_distinct(plain))).alias("want")).collect()
    assert all(r["got"] == r["want"] for r in got) and len(got) == len(rows)
    assert [r[0] for r in df.where("id = 4").select(F.size(N.text_bits(F.col("text"), width=1))).collect()] == [5]
    long = spark.range(1).select(F.expr("array_join(transform(sequence(1, 400000), i -> CAST(i AS STRING)), ' ')").alias("text"))
    start = time.time()
    assert 900 < long.select(F.size(N.text_bits(F.col("text")))).first()[0] <= 2048
    assert time.time() - start < 60  # 2.7 million characters: a substring for each would read 3.6 million MB


@pytest.mark.parametrize("case", ["common", "rare", "open", "names"])
def test_pairs_by_brute_force_without_a_join_by_bits(spark, case, monkeypatch):
    rng = random.Random(case)
    space, most = {"common": (40, 20), "rare": (4000, 40), "open": (4000, 40), "names": (300, 280)}[case]
    monkeypatch.setattr(bitindex, "TILE", 16)
    monkeypatch.setattr(bitindex, "AT_A_TIME", 7)
    if case == "open":
        monkeypatch.setattr(bitindex, "_PACKED", 100)
        monkeypatch.setattr(bitindex, "_AT_ONCE", 50)
    pool = [rng.sample(range(space), most) for _ in range(5)]
    bits = lambda: rng.sample(rng.choice(pool), rng.randrange(most)) + rng.sample(range(space), 2)
    name = (lambda i: f"N{i}") if case == "names" else (lambda i: i)
    sets = {side: [(name(i), bits()) for i in range(30)] + [(name(60), []), (name(61), None), (name(62), [3, 3, 5])] for side in "lr"}
    left, right = (spark.createDataFrame(sets[s], f"id {'string' if case == 'names' else 'bigint'}, bits array<int>").repartition(3) for s in "lr")
    want = {(i, j): round(len({*a} & {*b}) / len({*a} | {*b}), 9) for i, a in sets["l"] for j, b in sets["r"] if a and b and {*a} & {*b}}
    got = N.pair_similarities(left, right, "id", "id")
    assert {(x["q"], x["r"]): x["similarity"] for x in got.collect()} == want and got.count() == len(want)
    # what a plan shuffles are rows, not pairs of bits: no join is in it
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
    for t in (0.25, 0.666666667):
        found = N.threshold_matches(left, right, "id", "id", t).collect()
        assert {(x["q"], x["r"]): x["similarity"] for x in found} == {k: s for k, s in want.items() if s >= t} and len(found) == len({(x["q"], x["r"]) for x in found})


def test_nearest_of_few_bits_meets_in_tiles_and_visits_no_buckets(spark, monkeypatch):
    monkeypatch.setattr(bitindex, "TILE", 20)
    monkeypatch.setattr(bitindex, "AT_A_TIME", 7)
    rng = random.Random(8)
    bits = lambda: sorted(rng.sample(range(64), rng.choice([0, 2, 3, 3, 9])))
    q, r, qd, rd = _tables(spark, rng, bits)
    found, made = bitindex._found(qd, rd, 3, 1, None)
    assert len(found) == 1 and len(made) == 2  # one pass over tiles; the tables of both sides
    tiles = found[0].where("k < 0")
    assert tiles.count() > 1 and tiles.agg(F.sum("every")).first()[0] == len([1 for x in q if x[1]]) * len([1 for x in r if x[1]])
    got = {(x["q"], x["k"]): (x["r"], x["similarity"]) for x in bitindex.best_matches(qd, rd, 3).collect()}
    assert got == {(i, k): found[0] for i, b, g in q for k in range(3) if (found := _ranked(b, g, r, k, True))}


def test_pairs_are_rounded_in_their_tile_as_sql_rounds(spark):
    """Quotients of bit counts, ties of the last digit included, and no work by the row after the tile."""
    both, every = (v.ravel() for v in np.meshgrid(np.arange(1, 70), np.array([70, 97, 128, 512, 1024, 2048, 5120])))
    df = spark.createDataFrame(list(zip(both.tolist(), every.tolist())), "b bigint, e bigint").select("b", "e", F.round(F.col("b") / F.col("e"), bitindex.DIGITS).alias("s"))
    want = {(r["b"], r["e"]): r["s"] for r in df.collect()}
    assert {(b, e): s for b, e, s in zip(both.tolist(), every.tolist(), bitindex._rounded(both, every).tolist())} == want and want[1, 1024] == 0.000976563
    rows = spark.createDataFrame([(i, [i % 5, 7, 9 + i % 3]) for i in range(20)], "id bigint, bits array<int>")
    found = N.pair_similarities(rows, rows, "id", "id")
    assert found.count() == 400 and "round(" not in found._jdf.queryExecution().optimizedPlan().toString()
