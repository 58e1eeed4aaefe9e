import pytest
from pyspark.sql import functions as F

from panelyard.functions import scalars as S
from panelyard.operators import metrics as M
from panelyard.operators import models as ML
from panelyard.operators import ranking as K
from panelyard.operators import records as R
from panelyard.operators import scoring as G
from panelyard.operators import screen as V
from panelyard.operators import similarity as N
from panelyard.operators import spatial as X
from panelyard.operators import splits as P
from panelyard.operators import support as A
from panelyard.operators import textscan as L
from panelyard.sources import readers as IO
from panelyard.streaming.ingest import ingest


def test_similarity_cases(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, [1, 2]), (3, [2, 3]), (4, [9]), (5, [])], "id int, bits array<int>")
    got = {(r["q"], r["r"]): r["similarity"] for r in N.pair_similarities(df, df, "id", "id").collect()}
    assert got[1, 2] == 1.0 and round(got[1, 3], 6) == 0.333333 and (1, 4) not in got
    near = {r["q"]: r["nn"] for r in N.nearest(df, df.where("id = 3"), "id", "id").collect()}
    assert near == {1: round(1 / 3, 9), 2: round(1 / 3, 9), 3: 1.0, 4: 0.0, 5: 0.0}
    assert {(r["q"], r["r"]) for r in N.threshold_matches(df, df, "id", "id", 0.9).collect()} == {(1, 1), (1, 2), (2, 1), (2, 2), (3, 3), (4, 4)}


def test_regression_constant_and_empty(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "y double, p double")
    assert M.regression(df).first()["r2"] == 1.0
    assert M.regression(df.withColumn("p", F.lit(2.0))).first()["r2"] == 0.0
    assert M.regression(df.limit(0)).first()["n"] == 0


def test_conformal_index(spark):
    df = spark.range(10).select("id", F.lit(0.0).alias("y"), F.col("id").cast("double").alias("p"))
    r = M.conformal_band(df, F.lit(True)).first()
    assert r["halfwidth"] == 9.0  # level = min(1, ceil(11 * 0.9) / 10) = 1
    r = M.conformal_band(spark.range(100).select("id", F.lit(0.0).alias("y"), F.col("id").cast("double").alias("p")), F.lit(True)).first()
    assert r["halfwidth"] == 91.0  # ceil(0.91 * 99) = 91


def test_folds_keep_groups_whole(spark):
    df = spark.range(500).select("id", (F.col("id") % 17).alias("grp"))
    got = P.group_folds(df, k=5)
    assert got.count() == 500 and got.groupBy("grp").agg(F.countDistinct("fold").alias("n")).where("n > 1").count() == 0
    assert P.group_folds(df.where("grp < 2"), k=5).select("fold").distinct().count() == 2


def test_scramble_is_a_permutation(spark):
    df = spark.range(300).select("id", (F.col("id") * 2).alias("y"))
    got = P.scrambled(df).collect()
    assert sorted(r["y_scrambled"] for r in got) == sorted(r["y"] for r in got) and any(r["y"] != r["y_scrambled"] for r in got)
    assert P.scrambled(df.limit(0)).count() == 0


def test_pair_list_none_and_empty(spark):
    wide = spark.createDataFrame([("a", 1.0, 2.0)], "structure string, T0 double, T1 double")
    assert [r["comparator"] for r in P.pair_eligibility(wide, "T0", None).collect()] == ["T1"]
    assert P.pair_eligibility(wide, "T0", []).count() == 0
    assert P.pair_eligibility(wide, "T0", ["T5"]).first()["reason"] == "target absent"


def test_rank_metrics_perfect_and_single_class(spark):
    df = spark.createDataFrame([(i, i >= 15, float(i)) for i in range(20)], "id int, positive boolean, score double")
    r = A.rank_metrics(df).first()
    assert (r["average_precision"], r["roc_auc"], r["top_enrichment"]) == (1.0, 1.0, 4.0)
    assert A.rank_metrics(df.withColumn("positive", F.lit(True))).first()["roc_auc"] is None
    assert A.rank_metrics(df.withColumn("score", F.lit(1.0))).first()["roc_auc"] == 0.5


def _oof(spark, fn, n=200):
    return spark.createDataFrame([("p", i, float((i * 37) % 101) / 25, fn(i)) for i in range(n)], "pair string, id bigint, delta double, score double")


def test_support_verdicts(spark):
    strong = A.pair_support(_oof(spark, lambda i: float((i * 37) % 101) / 25 + 0.1 * (i % 3)), replicates=50).first()
    assert strong["supported"] and strong["lo"] > 0 and strong["reasons"] == ""
    noise = A.pair_support(_oof(spark, lambda i: float((i * 61) % 89) / 5), replicates=50).first()
    assert not noise["supported"] and "below zero" in noise["reasons"]
    flat = A.pair_support(_oof(spark, lambda i: 0.0).withColumn("delta", F.lit(0.2)), replicates=50).first()
    assert not flat["supported"] and "constant label" in flat["reasons"] and flat["lo"] is None


def test_production_basis(spark):
    v = lambda *s: spark.createDataFrame([(f"p{i}", x) for i, x in enumerate(s)], "pair string, supported boolean")
    assert A.production_basis(v(True, False, True)).first()["names"] == "p0,p2" and A.production_basis(v(True, False)).first()["unsupported"] == "p1"
    assert [A.production_basis(v(*s)).first()["basis"] for s in ((False, False), (True, False), (True, True))] == ["none", "supported_min", "all_min"]
    wide = spark.range(30).select(F.col("id").cast("string").alias("structure"), F.lit(1.0).alias("delta_T0_T1"))
    assert A.production_target(wide, "T0", []) is None and A.production_target(wide.limit(3), "T0", ["T1"]) is None and A.production_target(wide, "T0", ["T1"]).count() == 30


def test_screen_drops_nothing_and_null_never_promotes(spark):
    df = spark.createDataFrame([(1, 9.0, None, 0.9), (2, 9.0, 2.0, 0.9), (3, 9.0, 2.0, 0.5), (4, 9.0, 2.0, 0.35), (5, 9.0, 2.0, None), (6, 4.0, 2.0, 0.9)], "id int, prediction double, delta double, sim double")
    got = {r["id"]: (r["stratum"], r["priority"]) for r in V.annotate(df).collect()}
    assert got == {1: ("S1_in_domain", "none"), 2: ("S1_in_domain", "fep_first"), 3: ("S1_in_domain", "none"), 4: ("S2_near_domain", "abstain_out_of_ad"), 5: ("S3_far_novel", "abstain_out_of_ad"), 6: ("S1_in_domain", "qsar_below_hit_floor")}
    with pytest.raises(ValueError):
        V.Thresholds(derived_for="A").of("B")


def test_funnel_is_monotone(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), (None, 3, 5), ("b", 4, 50), ("c", 5, None)], "key string, pos int, size int")
    got = [(r["name"], r["dropped"], r["remaining"]) for r in V.funnel(df, [("big", F.col("size") > 10)]).orderBy("step").collect()]
    assert got == [("raw", 0, 5), ("unparseable", 1, 4), ("big", 2, 2), ("duplicate", 1, 1)]


def test_admits_needs_references(spark):
    none = spark.createDataFrame([], "name string, mw double, logp double, tpsa double")
    bounds = spark.createDataFrame([("mw_max", 400.0)], "bound string, value double")
    assert not V.check_admits(none, bounds).first()["passed"]
    one = spark.createDataFrame([("r", 450.0, 1.0, None)], none.schema)
    assert V.rejections(one, bounds).first()["reasons"] == "mw_max"


def test_scores_guard_against_one_bad_component(spark):
    spec = [G.Component("a", "sigmoid", 1.0, {"center": 0.0}), G.Component("b", "sigmoid", 1.0, {"center": 0.0})]
    df = spark.createDataFrame([(1, 9.0, -30.0), (2, 1.0, 1.0), (3, None, 9.0)], "id int, a double, b double")
    got = {r["id"]: r for r in G.scored(df, spec).collect()}
    assert got[1]["score_geo"] < got[2]["score_geo"] and got[3]["s_a"] == 0.0
    with pytest.raises(ValueError):
        G.checked([], ["a"])
    with pytest.raises(ValueError):
        G.checked(spec, ["a"])
    assert [c.name for c in G.checked(spec, ["a"], optional=("b",))] == ["a"]
    with pytest.raises(ValueError):
        S.transformed("cube", F.col("a"))
    with pytest.raises(ValueError):
        S.transformed("sigmoid", F.col("a"))


def test_descriptor_names():
    assert S.descriptors("t", []) == []
    with pytest.raises(ValueError):
        S.descriptors("t", ["weight"])


def test_fragments(spark):
    df = spark.createDataFrame([("CCO.[Na+].Cl",), ("[Na+].O",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(S.largest_fragment(F.col("s"))).collect()] == ["CCO", "[Na+]", None, None]


def test_metric_diff_kinds(spark):
    a = spark.createDataFrame([("x", 1.0), ("y", 2.0), ("z", None), ("w", 1.0)], "path string, value double")
    b = spark.createDataFrame([("x", 1.0 + 1e-15), ("y", 3.0), ("z", 1.0), ("v", 1.0)], "path string, value double")
    assert {r["path"]: r["kind"] for r in R.metric_diff(a, b).collect()} == {"y": "value", "z": "null", "w": "missing", "v": "extra"}
    assert R.record_hash(a).first() == R.record_hash(a.orderBy("path")).first()


def test_completeness_fails_closed(spark):
    with pytest.raises(ValueError):
        R.require_complete(R.completeness(spark.createDataFrame([], "target string"), spark.createDataFrame([], "target string, expected bigint")))


def test_shapes_that_look_around(spark):
    token = "ab_" + "x1" * 14
    cases = [(1, token, ["opaque-token"]), (2, "z" + token[:2] + "cdef_" + "x1" * 14, []), (3, "ab_" + "x" * 40, []), (4, token + "-", ["opaque-token"]), (5, "me@users.noreply.example.com", []),
             (6, "me@users.example.com me@users.noreply.example.com", ["non-noreply-email"]), (7, "/private/tmp/run-123456/x", ["machine-local-scratch"]), (8, "/tmp/run", []), (9, "token: " + "a" * 20, [])]
    df = spark.createDataFrame([(i, t) for i, t, _ in cases], "doc_id int, text string")
    got = L.scan(L.lines(df)).collect()
    assert {i: sorted(r["name"] for r in got if r["doc_id"] == i) for i, _, _ in cases} == {i: w for i, _, w in cases}
    assert all(token not in r["snippet"] for r in got) and [r["snippet"] for r in got if r["doc_id"] == 6] == ["<REDACTED> me@users.noreply.example.com"]


def test_scan_redacts_and_allows(spark):
    df = spark.createDataFrame([(1, "ok\npassword = abcdefghijklmnopqrst\nexample password = abcdefghijklmnopqrst")], "doc_id int, text string")
    got = L.scan(L.lines(df), allow="^example").collect()
    assert [(r["line_no"], r["name"], r["snippet"]) for r in got] == [(2, "inline-secret", "<REDACTED>")]
    with pytest.raises(ValueError):
        L.require_clean(L.lines(df.limit(0)), L.scan(L.lines(df.limit(0))))


def test_boxes(spark):
    pts = spark.createDataFrame([("e", g, float(x), 0.0, 0.0) for g, n in ((1, 5), (2, 3)) for x in range(n)], "entry string, grp int, x double, y double, z double")
    box = X.group_box(pts)
    assert box.first()["grp"] == 1 and X.box_qa(pts, box).first()["failed"] == ""
    with pytest.raises(ValueError):
        X.group_box(pts, named=9)
    assert X.within_radius(pts.where("grp = 1"), pts.where("grp = 2 AND x = 0"), 2.0).count() == 3


def test_band_of_zero(spark):
    assert spark.createDataFrame([(1.0,)], "p double").select(*ML.band(0.0, 0.9)).first() == (1.0, 1.0)


def test_out_of_fold_covers_all(spark, tmp_path):
    df = P.group_folds(spark.range(60).select("id", (F.col("id") % 7).alias("grp"), F.col("id").cast("double").alias("x"), (F.col("id") * 2.0).alias("y")), k=3)
    oof = ML.out_of_fold(ML.with_features(df, numbers=("x",)), lambda _: ML.forest(trees=3, depth=3), folds=3)
    assert oof.select("id").distinct().count() == 60 and oof.count() == 60
    rows = ML.with_features(df, numbers=("x",))
    model = ML.fit_all(rows, [ML.ridge(rows)])
    ML.save(model, str(tmp_path / "m"))
    assert ML.load(str(tmp_path / "m")).transform(rows).agg(F.max(F.abs(F.col("p") - F.col("y")))).first()[0] < 1.0


def test_snapshot_states(spark, tmp_path):
    import gzip
    import hashlib

    (tmp_path / "a.csv").write_text("1\n")
    (tmp_path / "c.csv").write_text("x\n")
    (tmp_path / "u.csv").write_text("?")
    with gzip.open(tmp_path / "b.csv.gz", "wb") as f:
        f.write(b"zip\n")
    sums = [(hashlib.sha256(b"1\n").hexdigest(), "a.csv"), (hashlib.sha256(b"zip\n").hexdigest(), "b.csv"), ("0" * 64, "c.csv"), ("1" * 64, "d.csv")]
    (tmp_path / "SUMS").write_text("# sums\n" + "".join(f"{h}  {n}\n" for h, n in sums))
    status = IO.verify_snapshot(IO.file_digests(spark, str(tmp_path), "*.csv*"), IO.read_sums(spark, str(tmp_path / "SUMS")))
    assert {r["name"]: r["status"] for r in status.collect()} == {"a.csv": "ok", "b.csv": "ok", "c.csv": "mismatch", "d.csv": "missing", "u.csv": "unlisted"}
    IO.require_verified(status, ["a.csv"])
    with pytest.raises(ValueError):
        IO.require_verified(status)


def test_library_scan(spark, tmp_path):
    import gzip

    (tmp_path / "lib.smi").write_text("CCO m1\n\nCCC\nCCN\tm3\n")
    rows = IO.read_library(spark, str(tmp_path / "lib.smi")).orderBy("pos")
    assert [tuple(r) for r in rows.collect()] == [(0, "CCO", "m1"), (2, "CCC", "row2"), (3, "CCN", "m3")]
    assert IO.read_library(spark, str(tmp_path / "lib.smi"), cap=2).count() == 2 and IO.read_library(spark, str(tmp_path / "lib.smi"), cap=9).count() == 3
    with gzip.open(tmp_path / "two.gz", "wt") as f:
        f.write("ZINC1 CCO\nalone\nCCC zinc2\n\nZINC3 CCN\nZINC4 C\n")
    got = IO.read_two_columns(spark, str(tmp_path / "two.gz"), "ZINC", start=1, n=2).orderBy("pos").collect()
    assert [tuple(r) for r in got] == [(2, "zinc2", "CCC"), (4, "ZINC3", "CCN")]


def test_library_pin(spark, tmp_path):
    import hashlib

    (tmp_path / "deck.smi").write_text("CCO m1\n")
    sha = hashlib.sha256(b"CCO m1\n").hexdigest()
    (tmp_path / "M").write_text(f"# shards\n{'0' * 64}  7  s1.smi  http://x/s1.smi\n{sha}  7  deck.smi  MERGED\n")
    assert IO.verify_pin(spark, str(tmp_path / "deck.smi"), str(tmp_path / "M"))["sha256"] == sha
    assert not IO.verify_pin(spark, str(tmp_path / "deck.smi"), None)["verified"]
    (tmp_path / "other.smi").write_text("CCC\n")
    with pytest.raises(ValueError):
        IO.verify_pin(spark, str(tmp_path / "other.smi"), str(tmp_path / "M"))
    (tmp_path / "deck.smi").write_text("changed\n")
    with pytest.raises(ValueError):
        IO.verify_pin(spark, str(tmp_path / "deck.smi"), str(tmp_path / "M"))


def test_merged_shards(spark, tmp_path):
    import gzip
    import hashlib

    (tmp_path / "a.smi").write_bytes(b"x\r\ny")  # no line end at the end
    with gzip.open(tmp_path / "b.smi.gz", "wb") as f:
        f.write(b"z\n")
    rows, manifest = IO.merge_shards(spark, str(tmp_path), "*.smi*")
    got = {r["name"]: (r["bytes"], r["sha256"], r["lines"]) for r in manifest.collect()}
    sums = {"a.smi": hashlib.sha256(b"x\r\ny").hexdigest(), "b.smi": hashlib.sha256(b"z\n").hexdigest()}
    assert got["a.smi"] == (4, sums["a.smi"], 2) and got["b.smi"] == (2, sums["b.smi"], 1)
    assert got["MERGED"] == (6, hashlib.sha256("\n".join(f"{h}  {n}" for n, h in sums.items()).encode()).hexdigest(), 3) and rows.count() == 3


def test_csv_read_and_write(spark, tmp_path):
    df = spark.createDataFrame([("IC50", "a,b"), ("Ki", None)], "standard_type string, canonical_smiles string")
    IO.write_table(df, str(tmp_path / "t"), "csv")
    back = IO.read_measurements(spark, str(tmp_path / "t"), "X")
    assert {(r["standard_type"], r["canonical_smiles"], r["target"]) for r in back.collect()} == {("IC50", "a,b", "X"), ("Ki", None, "X")}
    IO.write_table(df.select(F.lit("A1").alias("assay_chembl_id")).limit(1), str(tmp_path / "assays"), "csv")
    assays = IO.read_assays(spark, str(tmp_path / "assays"))
    assert assays.columns == list(IO.ASSAY_FIELDS) and assays.first()["description"] is None and assays.first()["assay_chembl_id"] == "A1"


def test_nested_records_round_trip(spark, tmp_path):
    import json

    flat = spark.createDataFrame([("a.b.c", 1.5), ("a.d", None), ("e", 2.0)], "path string, value double")
    IO.write_metrics(flat, str(tmp_path / "m"))
    (line,) = [r[0] for r in spark.read.text(str(tmp_path / "m")).collect()]
    assert json.loads(line) == {"a": {"b": {"c": 1.5}, "d": None}, "e": 2.0}
    nested = spark.createDataFrame([((1, True, ("t", 2.5)),)], "record struct<n:int,ok:boolean,in:struct<text:string,x:double>>")
    got = {r["path"]: (r["value"], r["flag"], r["text"]) for r in R.leaves(nested).collect()}
    assert got == {"n": (1.0, None, None), "ok": (None, True, None), "in.x": (2.5, None, None), "in.text": (None, None, "t")}
    other = R.leaves(spark.createDataFrame([((1, False, ("t", 2.5)),)], nested.schema))
    assert [(r["path"], r["kind"]) for r in R.metric_diff(R.leaves(nested), other, flag="flag").collect()] == [("ok", "bool")]


def test_decisions_and_manifest(spark):
    v = spark.createDataFrame([("a", True, 3, "x"), ("b", False, 4, "y")], "pair string, supported boolean, n bigint, reasons string")
    d = R.decisions(v)
    flags, texts = {"a": (True, "x"), "b": (False, "y")}, lambda r: (r["path"], r["value"], r["flag"], r["text"])
    assert {texts(r) for r in d.collect()} == {("a.n", 3.0, None, None), ("b.n", 4.0, None, None)} | {(f"{k}.supported", None, f, None) for k, (f, _) in flags.items()} | {(f"{k}.reasons", None, None, t) for k, (_, t) in flags.items()}
    exact = lambda other: sorted((r["path"], r["kind"]) for r in R.metric_diff(d, R.decisions(other), 0.0, flag="flag", text="text").collect())
    assert exact(v.withColumn("n", F.col("n") + 1)) == [("a.n", "value"), ("b.n", "value")] and exact(v) == []
    assert exact(v.withColumn("reasons", F.lit("x")).withColumn("supported", F.lit(True))) == [("b.reasons", "value"), ("b.supported", "bool")]
    assert {r["section"] for r in R.run_manifest(inputs=v, gates=d).collect()} == {"inputs", "gates"}


def test_ingest_resumes(spark, tmp_path):
    src, args = tmp_path / "in", (str(tmp_path / "out"), str(tmp_path / "cp"))
    src.mkdir()
    (src / "1.csv").write_text("a\n1\n2\n")
    assert ingest(spark, str(src), "a int", *args) == 2
    assert ingest(spark, str(src), "a int", *args) == 0
    (src / "2.csv").write_text("a\n3\n")
    assert ingest(spark, str(src), "a int", *args) == 1
    assert spark.read.parquet(args[0]).count() == 3


def test_acquisition_never_repeats(spark):
    pool = spark.range(40).select("id", (F.col("id") / 40.0).alias("score_geo"), (1 - F.col("id") / 40.0).alias("sim"))
    h = G.acquisition_rounds(pool, pool.select("id", F.col("score_geo").alias("measured")), 3, 5)
    assert h.count() == 15 and h.select("id").distinct().count() == 15


def test_quantiles_equal_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    rows = [(int(g), None if x > 0.98 else float(np.round(x, 2))) for g, x in zip(rng.integers(0, 4, 900), rng.random(900))] + [(9, None), (10, 5.0)]
    df = spark.createDataFrame(rows, "g int, x double").repartition(5)
    got = {r["g"]: (r["a"], r["b"], r["c"]) for r in K.quantiles(df, "x", {"a": 0.5, "b": 0.05, "c": 1.0}, ("g",)).collect()}
    for g in (0, 1, 2, 3, 10):
        v = [x for k, x in rows if k == g and x is not None]
        assert np.allclose(got[g], np.quantile(v, [0.5, 0.05, 1.0]))
    assert 9 not in got and K.quantiles(df.where("g = 9"), "x", {"a": 0.5}).count() == 0
    every = sorted(x for _, x in rows if x is not None)
    assert [K.kth(df, "x", i) for i in (0, 300, len(every) - 1)] == [every[0], every[300], every[-1]]


def test_quantiles_of_skewed_values_are_not_one_window(spark):
    df = spark.range(20_000).select(F.when(F.col("id") == 0, 1e12).otherwise(F.col("id") / 20_000.0).alias("x"))
    assert abs(K.quantiles(df, "x", {"m": 0.5}).first()["m"] - 0.500025) < 1e-4
    got = P.scrambled(spark.range(3_000).select(F.when(F.col("id") == 0, 10**12).otherwise(F.col("id")).alias("id"), F.col("id").alias("y")))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert got.select("y_scrambled").distinct().count() == 3_000 and "Window [" in plan and "_part" in plan


def test_ranked_and_running(spark):
    df = spark.createDataFrame([(g, v) for g in ("a", None) for v in range(50)], "g string, v int").repartition(4)
    got = {(r["g"], r["v"]): (r["r"], r["s"]) for r in K.running(K.ranked(df, ["g"], [F.col("v").desc()], "r"), ["g"], [F.col("v")], {"v": "s"}).collect()}
    assert all(got[g, v] == (50 - v, v * (v + 1) // 2) for g in ("a", None) for v in range(50))


def test_folds_follow_one_rule(spark):
    df = spark.range(400).select("id", F.when(F.col("id") < 200, 0).otherwise(F.col("id")).alias("grp"))
    got = P.group_folds(df, k=5).groupBy("fold").agg(F.countDistinct("grp").alias("n")).collect()
    assert {r["n"] for r in got} <= {40, 41} and len(got) == 5


def test_screen_library_and_skip(spark):
    lib = spark.createDataFrame([(1, [1, 2, 3]), (2, None), (3, [9])], "id bigint, bits array<int>")
    refs = spark.createDataFrame([(10, [1, 2, 3], "train"), (10, [1, 2, 3], "known"), (11, [1, 2], "actives")], "id bigint, bits array<int>, set_name string")
    predict = lambda d: d.withColumns({"prediction": F.lit(9.0), "delta": F.lit(None).cast("double")})
    got = {r["id"]: r for r in V.screen_library(lib, refs, predict).collect()}
    assert (got[1]["sim_train"], got[1]["sim_actives"], got[1]["sim_known"], got[1]["closest"], got[1]["priority"], got[1]["known_reference"]) == (1.0, round(2 / 3, 9), 1.0, 10, "none", True)
    assert (got[2]["stratum"], got[2]["priority"], got[2]["prediction"], got[2]["sim_train"], got[2]["parsed"]) == ("unparseable", "unparseable", None, None, False)
    assert (got[3]["sim_train"], got[3]["closest"], got[3]["stratum"], got[3]["priority"]) == (0.0, None, "S3_far_novel", "abstain_out_of_ad")
    status, out = V.screen_or_skip(False, lib, lambda x: x, spark)
    assert status.first()["status"] == "skipped" and out is None
    assert V.screen_or_skip(True, None, lambda x: x, spark)[0].first()["reason"] == "enabled=true, library=absent"
    status, out = V.screen_or_skip(True, lib, lambda x: x, spark)
    assert status.first()["status"] == "ran" and out.count() == 3


def test_ceiling_notes(spark):
    refs = lambda n: spark.range(n).select(F.lit(1.0).alias("mw"))
    assert V.ceiling_notes(refs(4)).first()["caveat"] is None and "only 3" in V.ceiling_notes(refs(3)).first()["caveat"] and V.ceiling_notes(refs(0)).first()["margin"] == 0.15


def test_arms_agree_where_they_must(spark):
    """Least squares is linear in the label, so the direct arm and the subtract arm predict alike."""
    df = spark.range(200).select("id", (F.col("id") % 4).alias("fold"), (F.col("id") % 17 / 3.0).alias("x"), (F.col("id") % 17 * 2.0 + F.col("id") % 5).alias("a"), (F.col("id") % 11 / 7.0).alias("b"))
    lines = ML.linear_arms(df).collect()
    assert all(abs(r["p_direct"] - r["p_subtract"]) < 1e-9 for r in lines)
    from pyspark.ml.regression import LinearRegression

    ols = lambda y: LinearRegression(labelCol=y, featuresCol="features", predictionCol="p", solver="normal")
    fitted = ML.delta_arms(ML.with_features(df, numbers=("x",)), {"direct": ("direct", ols), "subtract": ("subtract", ols)}, folds=4).collect()
    said = {(r["arm"], r["id"]): r["p"] for r in fitted}
    assert len(said) == 400 and all(abs(said["direct", r["id"]] - r["p_direct"]) < 1e-6 and abs(said["subtract", r["id"]] - r["p_direct"]) < 1e-6 for r in lines)
    with pytest.raises(ValueError):
        ML.delta_arms(ML.with_features(df, numbers=("x",)), {"x": ("other", ols)}, folds=1)


def test_plug_ins(spark):
    made = N.bits_by(spark.createDataFrame([(1, "abc"), (2, None)], "id int, key string"), lambda v: [None if x is None else sorted({ord(c) % 7 for c in x}) for x in v], "key")
    assert {r["id"]: r["bits"] for r in made.collect()} == {1: [0, 1, 6], 2: None}
    source = lambda s, n: s.range(n * 2).select("id", F.concat(F.lit("k"), F.col("id") % 6).alias("key"))
    assert [(r["id"], r["key"]) for r in G.sampled(source, spark, 5).collect()] == [(i, f"k{i}") for i in range(5)]
    with pytest.raises(ValueError):
        G.sampled(lambda s, n: s.range(n), spark, 5)
    calls = []
    pool = spark.range(20).select("id", (F.col("id") / 20.0).alias("sim"))
    retrain = lambda h: calls.append(h.count()) or (lambda d: d.withColumn("score_geo", -F.col("sim")))
    h = G.acquisition_rounds(pool, pool.select("id", F.col("sim").alias("measured")), 2, 3, ("exploit",), score=lambda d: d.withColumn("score_geo", F.col("sim")), retrain=retrain)
    assert sorted((r["round"], r["id"]) for r in h.collect()) == [(0, 17), (0, 18), (0, 19), (1, 0), (1, 1), (1, 2)] and calls == [3, 6]
    assert [r["n"] for r in G.round_trace(h).orderBy("round").collect()] == [3, 3]


def test_weighted_fit_and_carried_columns(spark):
    df = P.group_weights(spark.range(60).select("id", (F.col("id") < 50).cast("string").alias("grp"), (F.col("id") % 5).cast("double").alias("x"), (F.col("id") < 50).cast("double").alias("y"), F.lit(1.5).alias("label_pre")))
    rows = ML.with_features(df, numbers=("x",))
    assert "label_pre" in rows.columns and rows.where("label_pre = 1.5").count() == 60
    plain, weighted = (ML.forest(trees=5, depth=1, weight=w).fit(rows).transform(rows).agg(F.avg("p")).first()[0] for w in (None, "weight"))
    assert weighted < plain - 0.1  # the small group counts as much as the large one


def test_finished_panels_have_a_fixed_order(spark):
    from panelyard.operators import curate as C

    df = spark.createDataFrame([(1, "T0", 5.0, "s", "old")], "extra int, target string, label double, structure string, source string")
    out = C.finished(df, {"source": "new", "cutoff": 1999})
    assert out.columns == ["target", "structure", "label", "source", "extra", "cutoff"] and out.first()["source"] == "new"


def test_bootstrap_sums_equal_an_explode(spark):
    import numpy as np

    ids = np.array([0, 5, 990, 123456789, 7_000_000_000, 2**40])
    for some in (ids, np.concatenate([ids, [-3, -1_000_003]])):
        df = spark.createDataFrame([(int(i), r) for i in some for r in range(60)], "i bigint, r bigint")
        want = {(x["i"], x["r"]): x["w"] for x in df.select("i", "r", A.poisson_weight(S.hash_bucket(F.col("i") * 1009 + F.col("r") * 7919, 17)).alias("w")).collect()}
        got = A.poisson_weights(some, 60)
        assert all(got[r, k] == want[int(i), r] for k, i in enumerate(some) for r in range(60))
    rng = np.random.default_rng(2)
    rows = [("ab"[i % 2] if i % 7 else None, i, float(np.round(x, 2)), float(x + e)) for i, (x, e) in enumerate(zip(rng.normal(size=3000), rng.normal(size=3000)))] + [("c", 9000, 1.0, 2.0), ("a", None, 1.0, 1.0), ("a", 1, None, 1.0)]
    got = {r["g"]: r for r in A.bootstrap_r2(spark.createDataFrame(rows, "g string, id bigint, y double, p double").repartition(5), "g", replicates=40).collect()}
    assert set(got) == {"a", "b", None}  # a single row never varies
    for g in got:
        own = [r for r in rows if r[0] == g and r[1] is not None and r[2] is not None]
        w = A.poisson_weights(np.array([r[1] for r in own]), 40).astype(float)
        y, p = np.array([r[2] for r in own]), np.array([r[3] for r in own])
        r2 = 1 - (w @ (y - p) ** 2) / (w @ y**2 - (w @ y) ** 2 / w.sum(1))
        assert got[g]["replicates"] == 40 and np.allclose([got[g]["lo"], got[g]["hi"]], np.quantile(r2, [0.025, 0.975]), atol=2e-6)


def test_bootstrap_copies_no_rows(spark):
    df = spark.range(2000).selectExpr("'x' AS g", "id", "CAST(id % 50 AS DOUBLE) AS y", "CAST(id % 47 AS DOUBLE) AS p")
    plan = A.bootstrap_r2(df, "g")._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("MapInArrow") :]
    assert "Generate" not in below and "sequence" not in below
