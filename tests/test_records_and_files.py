"""Nested records, manifests, plug-ins, files of any size, line numbers by an index, sparse features and fits of folds."""

import gzip
import hashlib
import json
import random
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelyard.operators import models as ML
from panelyard.operators import metrics as M
from panelyard.operators import ranking as K
from panelyard.operators import records as R
from panelyard.operators import screen as V
from panelyard.operators import similarity as N
from panelyard.sources import readers as IO
from panelyard.sources.shared import kept


def _leaves(x, at=""):
    if isinstance(x, dict):
        return {k: v for name, y in x.items() for k, v in _leaves(y, f"{at}.{name}" if at else name).items()}
    if isinstance(x, list):
        return {k: v for i, y in enumerate(x) for k, v in _leaves(y, f"{at}[{i}]").items()}
    return {at: x}


def test_leaves_of_nested_records(spark):
    records = [
        {"n": 1, "a": [1, 2.5], "b": [{"c": 3, "d": [[True], ["x", None]]}], "empty": {}, "none": [], "t": "1"},
        [1, [2, [3, {"deep": {"er": [False]}}]]],
        {"a": {"b": {"c": {"d": {"e": "f"}}}}},
        7,
        None,
    ]
    df = spark.createDataFrame([(f"r{i}", json.dumps(r)) for i, r in enumerate(records)] + [("null", None)], "panel string, record string")
    got = {(r["panel"], r["path"]): r["flag"] if r["flag"] is not None else r["text"] if r["text"] is not None else r["value"] for r in R.leaves(df, by=("panel",)).collect()}
    assert got == {(f"r{i}", p): v for i, r in enumerate(records) for p, v in _leaves(r).items()}
    same = R.leaves(spark.createDataFrame([((1, [2.5, 3.5], {"k": "v"}, [(True, None)]),)], "record struct<n:int,a:array<double>,m:map<string,string>,s:array<struct<ok:boolean,x:double>>>"))
    assert {(r["path"], r["value"], r["flag"], r["text"]) for r in same.collect()} == {("n", 1.0, None, None), ("a[0]", 2.5, None, None), ("a[1]", 3.5, None, None), ("m.k", None, None, "v"), ("s[0].ok", None, True, None), ("s[0].x", None, None, None)}


def test_records_are_compared_with_arrays_and_texts(spark):
    one = {"x": [1.0, 2.0], "why": ["a", "b"], "ok": True, "one": True, "n": 3, "gone": 1, "sha": "p", "rho": 0.5, "inf": 1.0, "t": "1"}
    two = {"x": [1.0, 2.5], "why": ["a", "c", "d"], "ok": False, "one": 1, "n": None, "sha": "q", "rho": 0.5000001, "inf": 1.0, "t": 1}
    a, b = (R.leaves(spark.createDataFrame([(json.dumps(r),)], "record string")) for r in (one, two))
    b = b.withColumn("value", F.when(F.col("path") == "inf", F.lit(float("inf"))).otherwise(F.col("value")))
    diff = lambda **more: {r["path"]: r["kind"] for r in R.metric_diff(a, b, flag="flag", text="text", ignored=("sha",), **more).collect()}
    want = {"x[1]": "value", "why[1]": "value", "why[2]": "extra", "ok": "bool", "n": "null", "gone": "missing", "inf": "non_finite", "t": "value"}
    assert diff(ranks=("rho",), rank_tol=1e-6) == want and diff() == want | {"rho": "value"} and diff(absolute=True, rel_tol=1e-6) == want


def test_panel_manifest_holds_inputs_attrition_and_gates(spark):
    inputs = spark.createDataFrame([("p", "b.csv", 5, "22"), ("p", "a.csv", 3, "11"), ("q", "c.csv", 1, "33")], "target string, name string, bytes bigint, sha256 string")
    attrition = spark.createDataFrame([("p", 1, "raw", 9), ("p", 2, "kept", 4)], "target string, step int, name string, n bigint")
    gates = spark.createDataFrame([("p", "r2", True), ("p", "leak", True), ("q", "r2", None)], "target string, metric string, passed boolean")
    got = {r["target"]: json.loads(r["record"]) for r in R.panel_manifest(inputs, attrition, gates, {"cutoff": 2022}).collect()}
    assert got["p"]["inputs"] == [{"name": "a.csv", "bytes": 3, "sha256": "11"}, {"name": "b.csv", "bytes": 5, "sha256": "22"}] and got["p"]["settings"] == {"cutoff": 2022}
    assert got["p"]["inputs_sha256"] == hashlib.sha256(b"11  a.csv\n22  b.csv").hexdigest() and got["p"]["passed"] and len(got["p"]["attrition"]) == 2
    assert got["q"]["attrition"] == [] and not got["q"]["passed"]


def test_plugged_in_keys_keep_other_columns(spark):
    df = spark.createDataFrame([(2**60 + 1, "B.A"), (None, "bad"), (3, None)], "id bigint, structure string").repartition(2)
    got = N.keys_by(df, lambda xs: [None if x in (None, "bad") else ".".join(sorted(x.split("."))) for x in xs], "structure")
    assert sorted(((r["id"], r["key"]) for r in got.collect()), key=repr) == sorted([(2**60 + 1, "A.B"), (None, None), (3, None)], key=repr)
    with pytest.raises(Exception, match="returned 0 values"):
        N.keys_by(df.limit(1), lambda xs: [], "structure").collect()


def test_digests_of_files_of_any_size(spark, tmp_path):
    with gzip.open(tmp_path / "two.gz", "wb") as f:
        f.write(b"a" * 3_000_000)
    with open(tmp_path / "two.gz", "ab") as f:
        f.write(gzip.compress(b"second member"))
    (tmp_path / "none.txt").write_bytes(b"")
    with open(tmp_path / "large.bin", "wb") as f:
        f.truncate(3 << 30)  # a sparse file
    got = {r["name"]: (r["bytes"], r["sha256"]) for r in IO.file_digests(spark, str(tmp_path)).collect()}
    zeros = hashlib.sha256()
    for _ in range(3 << 10):
        zeros.update(bytes(1 << 20))
    assert got["large.bin"] == (3 << 30, zeros.hexdigest()) and got["none.txt"] == (0, hashlib.sha256(b"").hexdigest())
    assert got["two"] == (3_000_013, hashlib.sha256(b"a" * 3_000_000 + b"second member").hexdigest())
    code = "import resource, sys; from panelyard.sources.readers import stream_digest; from pyarrow import fs; s = fs.LocalFileSystem().open_input_stream(sys.argv[1]); before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss; stream_digest(s, False); print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)"
    grown = int(subprocess.run([sys.executable, "-c", code, str(tmp_path / "large.bin")], capture_output=True, text=True, check=True).stdout.split()[-1])
    assert grown < 50_000  # KB
    with open(tmp_path / "cut.gz", "wb") as f:
        f.write(gzip.compress(random.Random(1).randbytes(9000))[:-20])
    with pytest.raises(Exception, match="ends too early"):
        IO.file_digests(spark, str(tmp_path), "cut*").collect()


def test_slices_read_the_files_that_hold_them(spark, tmp_path):
    n = 0
    for k, size in enumerate((5, 0, 7, 3)):
        (tmp_path / f"f{k}.smi").write_text("".join(f"ZINC{n + i} k{n + i}\n" if (n + i) % 4 else "\n" for i in range(size)))
        n += size
    index = kept(IO.line_index(spark, str(tmp_path)), "index")
    assert sorted((r["first"], r["n"]) for r in index.collect()) == [(0, 5), (5, 7), (12, 3)]
    want = [(i, f"ZINC{i}") for i in range(15) if i % 4]
    for start, m in ((0, None), (6, 3), (12, None), (6, 100), (40, 2)):
        rows = [x for x in want if x[0] >= start][:m]
        for known in (None, index):
            got = IO.read_two_columns(spark, str(tmp_path), "ZINC", start, m, known)
            assert sorted((r["pos"], r["id"]) for r in got.collect()) == rows
    (tmp_path / "f0.smi").unlink()  # not needed from line 5 on
    assert IO.read_two_columns(spark, str(tmp_path), "ZINC", 5, None, index).count() == 8


def test_smallest_rows_are_filtered(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, 1, 2, 3]), i, "x" * i) for i in range(200)]
    df = spark.createDataFrame(rows, "h int, pos int, more string").repartition(7)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for n in (0, 1, 60, 199, 200, 500):
        assert sorted(tuple(r) for r in K.smallest(df, n, ["h", "pos"]).select("pos").collect()) == sorted((r[1],) for r in order[:n])
    assert "Limit" not in K.smallest(df, 60, ["h", "pos"])._jdf.queryExecution().optimizedPlan().toString()
    assert [r["pos"] for r in V.seeded_cap(df.where("h IS NOT NULL"), 5).collect()] == sorted(r[1] for r in [x for x in order if x[0] is not None][:5])


def test_features_are_sparse_and_fit_alike(spark):
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.linalg import SparseVector

    rng = random.Random(3)
    rows = [(i, sorted(rng.sample(range(300), rng.randint(0, 12))), float(rng.random()), float(rng.random())) for i in range(120)] + [(500, None, 1.0, 1.0), (501, [1], None, 1.0), (502, [1, 1, 7], 0.5, 1.0)]
    df = spark.createDataFrame(rows, "id bigint, bits array<int>, x double, y double")
    made = ML.with_features(df, "bits", 300, ("x",))
    assert made.columns == ["id", "bits", "x", "y", "features"] and made.count() == 121
    assert "array_contains" not in made._jdf.queryExecution().optimizedPlan().toString()
    one = made.where("id = 502").first()["features"]
    assert isinstance(one, SparseVector) and one.size == 301 and one.indices.tolist() == [1, 7, 300]
    dense = df.where("bits IS NOT NULL AND x IS NOT NULL").withColumn("features", array_to_vector(F.concat(F.transform(F.sequence(F.lit(0), F.lit(299)), lambda i: F.array_contains("bits", i).cast("double")), F.array("x"))))
    said = [{r["id"]: r["p"] for r in ML.ridge(t).fit(t).transform(t).collect()} for t in (made, dense)]
    assert said[0].keys() == said[1].keys() and all(abs(said[0][k] - said[1][k]) < 1e-6 for k in said[0])


def test_fits_are_accurate_on_held_out_rows(spark):
    rows = spark.range(900).select("id", (F.col("id") % 5).alias("fold"), (F.col("id") % 31 / 31.0).alias("x"), (F.col("id") % 17 / 17.0).alias("z"), F.when(F.col("id") % 2 == 0, "T0-T1").otherwise("T0-T2").alias("pair"))
    a, b = 5 + 3 * F.col("x") + F.when(F.col("z") > 0.5, 2.0).otherwise(0.0), 4 - 2 * F.col("x")
    rows = ML.with_features(rows.withColumns({"a": a, "b": b, "y": a, "grp": F.col("fold")}), numbers=("x", "z"))
    assert M.regression(ML.out_of_fold(rows, lambda _: ML.forest(trees=20, depth=6))).first()["r2"] > 0.95
    train, test = rows.where("fold > 0"), rows.where("fold = 0")
    assert M.regression(ML.boosted(rounds=30, depth=4, step=0.3).fit(train).transform(test)).first()["r2"] > 0.98
    assert M.regression(ML.ridge(train, alpha=0.01).fit(train).transform(test)).first()["r2"] > 0.6
    arms = {"direct": ("direct", lambda y: ML.forest(y, 20, 6)), "subtract": ("subtract", lambda y: ML.forest(y, 20, 6))}
    got = {(r["pair"], r["arm"]): r for r in M.regression(ML.delta_arms(rows, arms, by="pair"), "pair", "arm").collect()}
    assert len(got) == 4 and all(r["n"] == 450 and r["r2"] > 0.95 for r in got.values())


def test_fits_by_sums_are_those_of_the_rows(spark):
    """Sums of each bag against the rows' own; accuracy on held-out rows as of MLlib on rows; rows without a label are predicted, those without a number are not."""
    rows = spark.range(2000).select("id", (F.col("id") % 5).alias("fold"), (F.col("id") % 31 / 31.0).alias("x"), (F.col("id") % 17 / 17.0).alias("z"), (F.col("id") % 5 == 0).alias("test"))
    y = 5 + 3 * F.col("x") + F.when(F.col("z") > 0.5, 2.0).otherwise(0.0) + F.col("id") % 3 / 10
    rows = rows.withColumns({"y": F.when(F.col("id") != 7, y), "grp": F.col("fold"), "x": F.when(F.col("id") != 11, F.col("x"))})
    sums = ML.bag_sums(rows, ("x", "z"), "fold", 3, lambda h: (h < 2**31).cast("int"))
    h = F.pmod(F.xxhash64("id", F.lit(1), F.lit(0)), F.lit(1 << 32))
    plain = rows.where((h < 2**31) & F.col("y").isNotNull() & F.col("x").isNotNull()).groupBy("fold", "x", "z").agg(F.count("*").alias("n"), F.sum("y").alias("t"), F.sum(F.col("y") ** 2).alias("u"))
    both = sums.where("bag = 1 AND w > 0").join(plain, ["fold", "x", "z"]).collect()
    assert len(both) == plain.count() == sums.where("bag = 1 AND w > 0").count() and all(r["w"] == r["n"] and abs(r["s"] - r["t"]) < 1e-9 and abs(r["q"] - r["u"]) < 1e-9 for r in both)
    oof = ML.forest_by_sums(rows, ("x", "z"), trees=6, depth=6).cache()
    assert oof.count() == 1999 and M.regression(oof).first()["r2"] > 0.9 and oof.where("id = 7 AND y IS NULL AND p IS NOT NULL").count() == 1
    said = ML.boosted_by_sums(rows, ("x", "z"), rounds=12, depth=4, step=0.3)
    row = ML.with_features(rows.where("y IS NOT NULL"), numbers=("x", "z"))
    there = M.regression(ML.boosted(rounds=12, depth=4, step=0.3).fit(row.where("NOT test")).transform(row.where("test"))).first()
    assert said.count() == 400 and abs(M.regression(said).first()["r2"] - there["r2"]) < 0.02 and there["r2"] > 0.9
    again = {r["id"]: r["p"] for r in ML.boosted_by_sums(rows.repartition(7, "z"), ("x", "z"), rounds=12, depth=4, step=0.3).collect()}
    assert all(abs(again[r["id"]] - r["p"]) < 1e-6 for r in said.collect())


def _cart(cells, depth):
    """{cell: mean of its leaf} of the tree of one feature that tries all thresholds; cells: (x, weight, weighted label)."""
    mean = lambda c: sum(s for _, _, s in c) / sum(w for _, w, _ in c)
    seen = sorted({x for x, w, _ in cells if w})
    best, at = 1e-12, None
    for lo, hi in zip(seen, seen[1:]) if depth else ():
        parts = [[c for c in cells if c[1] and (c[0] > lo) == over] for over in (False, True)]
        gain = sum(mean(p) ** 2 * sum(w for _, w, _ in p) for p in parts) - mean(cells) ** 2 * sum(w for _, w, _ in cells)
        if gain > best:
            best, at = gain, (lo + hi) / 2
    if at is None:
        return {x: mean(cells) for x, _, _ in cells}
    return _cart([c for c in cells if c[0] <= at], depth - 1) | _cart([c for c in cells if c[0] > at], depth - 1)


def test_the_registered_forest_is_whole_and_its_trees_are_those_of_all_thresholds(spark, sf, monkeypatch):
    """400 trees without a bound on their depth but MLlib's; each tree against one grown in Python from the rows and their weights."""
    import inspect

    from panelyard.operators.support import poisson_bags
    from panelyard.plans import queries2, registry

    called, made = [], ML.forest_by_sums
    monkeypatch.setattr(queries2.ML, "forest_by_sums", lambda *a, **k: called.append(inspect.signature(made).bind(*a, **k)) or a[0].withColumn("p", F.lit(0.0)))
    registry.QUERIES["rf_fit"](spark, sf)
    called[0].apply_defaults()
    assert called[0].arguments["trees"] >= 400 and called[0].arguments["depth"] >= 30 and called[0].arguments["folds"] == 5
    rows = spark.range(400).select("id", (F.col("id") % 3).alias("fold"), (F.col("id") * F.col("id") % 23).alias("x"), F.lit(0).alias("grp"), (F.col("id") * 7919 % 101 / 7.0).alias("y"), F.xxhash64("id", F.lit(5)).alias("h"))
    rows = rows.withColumn("x", F.when(F.col("id") == 399, 99).otherwise(F.col("x"))).cache()  # a value of one fold only
    for depth in (2, 30):
        got = {r["id"]: r["p"] for r in made(rows, ("x",), folds=3, trees=4, depth=depth, seed=5).collect()}
        plain = rows.collect()
        weights = poisson_bags(np.array([r["h"] for r in plain]).view(np.uint64), 4)
        want = {r["id"]: 0.0 for r in plain}
        for k in range(3):
            for t in range(4):
                cells = {r["x"]: (r["x"], 0.0, 0.0) for r in plain}
                for r, w in zip(plain, weights[:, t].tolist()):
                    if r["fold"] != k:
                        x, n, s = cells[r["x"]]
                        cells[x] = x, n + w, s + w * r["y"]
                leaf = _cart(list(cells.values()), depth)
                for r in plain:
                    want[r["id"]] += leaf[r["x"]] / 4 if r["fold"] == k else 0.0
        assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in want)


def test_records_are_computed_once_and_customers_are_not_broadcast(spark, sf):
    from panelyard.plans import queries2

    plan = queries2._nation_records(spark, sf, False)._jdf.queryExecution().optimizedPlan().toString()
    join = next(i for i, line in enumerate(plan.splitlines()) if "Join LeftOuter" in line)
    assert any("Aggregate [c_nationkey" in line for line in plan.splitlines()[join:])
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    records = spark.createDataFrame([('{"a": {"b": [1, {"c": true}]}, "d": "x"}',)], "record string").mapInArrow(counted, "record string")
    got = {(r["path"], r["value"], r["flag"], r["text"]) for r in R.leaves(records).collect()}
    assert got == {("a.b[0]", 1.0, None, None), ("a.b[1].c", None, True, None), ("d", None, None, "x")} and runs.value == 1
