"""Queries by name, continued: support, screening, scores, records, text, space, models, landed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelyard.functions import scalars as S
from panelyard.operators import metrics as M
from panelyard.operators import models as ML
from panelyard.operators import records as R
from panelyard.operators import scoring as G
from panelyard.operators import screen as V
from panelyard.operators import spatial as X
from panelyard.operators import splits as P
from panelyard.operators import support as A
from panelyard.operators import textscan as L
from panelyard.plans.fixtures import bucket, view
from panelyard.plans.queries import PAIRS, PANEL, SIM, _bits, _pairs, _panel, _reference_sets, query, rounded
from panelyard.sources import readers as IO
from panelyard.sources.shared import fresh_folder, kept
from panelyard.streaming.ingest import ingest, screen_blocks

# support --------------------------------------------------------------------------------------------------------------

_U = f"({bucket('(id * 1009 + rep * 7919)', 17)}) / 4294967296"
_W = "CASE " + " ".join(f"WHEN u < {x!r} THEN {k}" for k, x in enumerate(A.POISSON)) + " ELSE 7 END"
REPLICATES = 1000
BOOT = PAIRS + f""", d AS (SELECT pair, rep, delta AS y, score AS p, {_W} AS w FROM (SELECT *, {_U} AS u FROM pairs, range({REPLICATES}) AS g(rep)) AS q),
r AS (SELECT pair, rep, 1 - sum(w * (y - p) * (y - p)) / (sum(w * y * y) - sum(w * y) * sum(w * y) / sum(w)) AS r2 FROM d WHERE w > 0 GROUP BY pair, rep HAVING max(y) > min(y)),
ci AS (SELECT pair, count(*) AS replicates, round(quantile_cont(r2, 0.025), 6) AS lo, round(quantile_cont(r2, 0.975), 6) AS hi FROM r GROUP BY pair)"""


@query("bootstrap_ci", f"WITH {BOOT} SELECT pair, replicates, lo, hi FROM ci")
def _(spark, d):
    return A.bootstrap_r2(_pairs(spark, d), "pair", replicates=REPLICATES, y="delta", p="score")


VERDICT = BOOT + """, n AS (SELECT pair, count(*) AS n, count(*) FILTER (delta >= 1.0) AS n_selective FROM pairs GROUP BY pair),
v AS (SELECT n.*, round(n_selective / n, 6) AS prevalence, lo, hi, concat_ws('; ', CASE WHEN hi < 0 THEN 'interval below zero' WHEN lo <= 0 THEN 'interval spans zero' END,
  CASE WHEN n_selective = 0 THEN 'constant label' WHEN round(n_selective / n, 6) < 0.05 THEN 'few positives' END) AS reasons, lo > 0 AND n_selective > 0 AS supported FROM n JOIN ci USING (pair))"""


@query("pair_support", f"WITH {VERDICT} SELECT pair, n, n_selective, prevalence, lo, hi, reasons, supported FROM v")
def _(spark, d):
    return A.pair_support(_pairs(spark, d), replicates=REPLICATES)


@query("production_basis", f"WITH {VERDICT}, o AS (SELECT count(*) AS pairs, count(*) FILTER (supported) AS supported_pairs, coalesce(string_agg(pair, ',' ORDER BY pair) FILTER (supported), '') AS names, coalesce(string_agg(pair, ',' ORDER BY pair) FILTER (NOT supported), '') AS unsupported FROM v) SELECT *, CASE WHEN supported_pairs = 0 THEN 'none' WHEN supported_pairs < pairs THEN 'supported_min' ELSE 'all_min' END AS basis FROM o")
def _(spark, d):
    return A.production_basis(A.pair_support(_pairs(spark, d), replicates=REPLICATES))


def _rank_sql(source: str, by: str) -> str:
    """Average precision by distinct score, AUC by average ranks, the top tenth by score, then id."""
    key, part, using = (f"{by}, ", f"PARTITION BY {by}", f"USING ({by})") if by else ("", "", "")
    join = lambda t: f"JOIN {t} {using}" if by else f", {t}"
    group = f"GROUP BY {by}" if by else ""
    return f"""z AS (SELECT {key}id, s, pos, row_number() OVER ({part} ORDER BY s DESC, id) AS k, rank() OVER ({part} ORDER BY s) + (count(*) OVER (PARTITION BY {key}s) - 1) / 2.0 AS ar FROM ({source}) AS src),
t AS (SELECT {key}count(*) AS n, count(*) FILTER (pos) AS p, sum(ar) FILTER (pos) AS sr FROM z {group}),
g AS (SELECT {key}s, count(*) AS n1, count(*) FILTER (pos) AS p1 FROM z GROUP BY {key}s), c AS (SELECT *, sum(n1) OVER ({part} ORDER BY s DESC) AS cn, sum(p1) OVER ({part} ORDER BY s DESC) AS cp FROM g),
ap AS (SELECT {key}sum(p1 * cp / cn) AS ap FROM c {group}), h AS (SELECT {"z." + by + ", " if by else ""}count(*) FILTER (pos) AS hits FROM z {join('t')} WHERE k <= greatest(1, floor(t.n * 0.1)) {"GROUP BY z." + by if by else ""})
SELECT {"t." + by + ", " if by else ""}t.n, t.p AS positives, round(t.p / t.n, 6) AS prevalence, CASE WHEN t.p > 0 AND t.p < t.n THEN round(ap.ap / t.p, 6) END AS average_precision,
  CASE WHEN t.p > 0 AND t.p < t.n THEN round((sr - t.p * (t.p + 1) / 2) / t.p / (t.n - t.p), 6) END AS roc_auc, CASE WHEN t.p > 0 AND t.p < t.n THEN round(ap.ap / t.p / (t.p / t.n), 6) END AS lift,
  CASE WHEN t.p > 0 AND t.p < t.n THEN round(h.hits / greatest(1, floor(t.n * 0.1)) / (t.p / t.n), 6) END AS top_enrichment FROM t {join('ap')} {join('h')}"""


@query("rank_metrics", f"WITH {PAIRS}, " + _rank_sql("SELECT pair, id, round(score, 1) AS s, delta >= 1.0 AS pos FROM pairs", "pair"))
def _(spark, d):
    return A.rank_metrics(_pairs(spark, d).select("pair", "id", F.round("score", 1).alias("score"), (F.col("delta") >= 1.0).alias("positive")), "pair")


ARMS_CV = PAIRS + f""", wp AS (SELECT structure, pair, id, a, b, a - b AS y, {bucket("id", 4)} % 5 AS fold, {bucket("id", 6)} % 1000 / 100.0 AS x FROM (
  SELECT w.structure, p.pair, p.id, w.T0 AS a, CASE p.pair WHEN 'T0-T1' THEN w.T1 WHEN 'T0-T2' THEN w.T2 ELSE w.T3 END AS b FROM pairs AS p JOIN wide AS w ON p.structure = w.structure) AS j),
own AS (SELECT pair, fold, count(*)::DOUBLE AS n, sum(x) AS x, sum(x * x) AS xx, sum(a) AS a, sum(b) AS b, sum(x * a) AS xa, sum(x * b) AS xb FROM wp GROUP BY pair, fold),
oth AS (SELECT o.pair, o.fold, sum(q.n) AS n, sum(q.x) AS x, sum(q.xx) AS xx, sum(q.a) AS a, sum(q.b) AS b, sum(q.xa) AS xa, sum(q.xb) AS xb FROM own AS o JOIN own AS q ON o.pair = q.pair AND o.fold <> q.fold GROUP BY o.pair, o.fold),
said AS (SELECT wp.pair, wp.y, (s.a - s.b) / s.n AS p_mean, (s.a - s.b) / s.n + ((s.xa - s.xb) - s.x * (s.a - s.b) / s.n) / (s.xx - s.x * s.x / s.n) * (wp.x - s.x / s.n) AS p_direct,
  (s.a / s.n + (s.xa - s.x * s.a / s.n) / (s.xx - s.x * s.x / s.n) * (wp.x - s.x / s.n)) - (s.b / s.n + (s.xb - s.x * s.b / s.n) / (s.xx - s.x * s.x / s.n) * (wp.x - s.x / s.n)) AS p_subtract FROM wp JOIN oth AS s ON wp.pair = s.pair AND wp.fold = s.fold)"""


def _arm_rows(spark: SparkSession, d: str) -> DataFrame:
    """Paired rows with a fold and a feature, the same for all arms."""
    bucket_of = lambda seed: S.hash_bucket(F.col("id"), seed)
    return _pairs(spark, d).select("pair", "id", "a", "b", (bucket_of(4) % 5).alias("fold"), (bucket_of(6) % 1000 / 100.0).alias("x"))


_ARM_ROWS = " UNION ALL ".join(f"SELECT pair, '{n}' AS arm, y, p_{n} AS p FROM said" for n in ("direct", "subtract", "mean"))


@query("arm_compare", f"WITH {ARMS_CV} SELECT pair, arm, count(*) AS n, round(1 - sum((y - p) * (y - p)) / regr_syy(y, y), 6) AS r2, round(avg(abs(y - p)), 6) AS mae, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse FROM ({_ARM_ROWS}) AS u GROUP BY pair, arm")
def _(spark, d):
    said = ML.linear_arms(_arm_rows(spark, d), by=("pair",))
    arms = F.explode(F.array(*[F.struct(F.lit(n).alias("arm"), F.col(f"p_{n}").alias("p")) for n in ("direct", "subtract", "mean")]))
    return M.regression(said.select("pair", (F.col("a") - F.col("b")).alias("y"), arms.alias("x")).select("pair", "y", "x.*"), "pair", "arm")


@query("delta_arms_fit")
def _(spark, d):
    """Forests for the difference, forests for both values, boosting for both values, for every pair of targets: on the same folds and features."""
    rows = ML.with_features(_arm_rows(spark, d).withColumn("z", F.col("id") % 7 / 7.0), numbers=("x", "z"))
    arms = {"direct_rf": ("direct", lambda y: ML.forest(y, 20, 5)), "subtract_rf": ("subtract", lambda y: ML.forest(y, 20, 5)), "subtract_boosted": ("subtract", lambda y: ML.boosted(y, 5, 3))}
    return M.regression(ML.delta_arms(rows, arms, by="pair"), "pair", "arm")


# screening ------------------------------------------------------------------------------------------------------------


def _fails() -> list:
    return [("physchem", ~F.col("size").between(200, 5000)), ("alert", F.col("key").rlike("licen[sc]e|!!"))]


FUNNEL = r"m AS (SELECT *, CASE WHEN key IS NULL THEN 'unparseable' WHEN NOT size BETWEEN 200 AND 5000 THEN 'physchem' WHEN regexp_matches(key, 'licen[sc]e|!!') THEN 'alert' END AS reason FROM {fx_library})"


@query("library_funnel", f"""
WITH {FUNNEL}, c AS (SELECT count(*) AS raw, count(*) FILTER (reason = 'unparseable') AS u, count(*) FILTER (reason = 'physchem') AS p, count(*) FILTER (reason = 'alert') AS a, count(*) FILTER (reason IS NULL) - count(DISTINCT key) FILTER (reason IS NULL) AS dup FROM m)
SELECT 0 AS step, 'raw' AS name, 0::BIGINT AS dropped, raw AS remaining FROM c UNION ALL SELECT 1, 'unparseable', u, raw - u FROM c UNION ALL SELECT 2, 'physchem', p, raw - u - p FROM c UNION ALL SELECT 3, 'alert', a, raw - u - p - a FROM c UNION ALL SELECT 4, 'duplicate', dup, raw - u - p - a - dup FROM c""")
def _(spark, d):
    return V.funnel(view(spark, d, "fx_library"), _fails())


@query("dedup_first", "SELECT md5(key) AS key, min(pos) AS first, count(*) AS copies FROM {fx_library} WHERE key IS NOT NULL GROUP BY key")
def _(spark, d):
    return V.first_of_each(view(spark, d, "fx_library")).withColumn("key", F.md5("key"))


@query("seeded_cap", "SELECT doc_id, pos FROM (SELECT doc_id, pos FROM {fx_library} ORDER BY h, pos LIMIT 100) ORDER BY pos")
def _(spark, d):
    return V.seeded_cap(view(spark, d, "fx_library").select("doc_id", "pos", "h"), 100).select("doc_id", "pos")


@query("seeded_shuffle", "SELECT doc_id, h FROM {fx_library} ORDER BY h, pos")
def _(spark, d):
    return V.seeded_shuffle(view(spark, d, "fx_library").select("doc_id", "pos", "h")).select("doc_id", "h")


@query("potency_cut", f"WITH {PANEL}, c AS (SELECT round(quantile_cont(label, 0.75), 6) AS cut FROM panel WHERE target = 'T0') SELECT cut, count(*) FILTER (label >= cut) AS n_over, 'quantile 0.75' AS how FROM panel, c WHERE target = 'T0' GROUP BY cut")
def _(spark, d):
    return V.potency_cut(_panel(spark, d).where("target = 'T0'"))


_env = lambda p, low, high: (f"SELECT '{low}' AS bound, round(greatest(0, lo - pad), 3) AS value FROM e WHERE property = '{p}' UNION ALL " if low else "") + f"SELECT '{high}', round(hi + pad, 3) FROM e WHERE property = '{p}'"
_ALL_BOUNDS = " UNION ALL ".join(_env(*b) for b in V.BOUNDS)
_PROPERTIES = lambda where: " UNION ALL ".join(f"SELECT '{p}' AS property, {p}::DOUBLE AS v FROM {{fx_candidates}} WHERE {where}" for p, _, _ in V.BOUNDS)
_REF = "id % 97 = 3"
ENVELOPE = f"act AS ({_PROPERTIES('prediction >= 7.5')}), e0 AS (SELECT property, quantile_cont(v, 0.05) AS lo, quantile_cont(v, 0.95) AS hi, (quantile_cont(v, 0.95) - quantile_cont(v, 0.05)) * 0.15 AS pad FROM act GROUP BY property), env AS ({_ALL_BOUNDS.replace('FROM e ', 'FROM e0 ')})"
CEILING = f"ref AS ({_PROPERTIES(_REF)}), nr AS (SELECT count(*) AS n FROM {{fx_candidates}} WHERE {_REF}), e1 AS (SELECT property, min(v) AS lo, max(v) AS hi, (max(v) - min(v)) * (0.15 * (1 + 2.0 / sqrt(any_value(n)))) AS pad FROM ref, nr WHERE property IN ('mw', 'logp') GROUP BY property), ceiling AS ({_ALL_BOUNDS.replace('FROM e ', 'FROM e1 ')})"
BOTH = f"{ENVELOPE}, {CEILING}, win AS (SELECT bound, CASE WHEN bound LIKE '%_max' THEN min(value) ELSE max(value) END AS value FROM (SELECT * FROM env UNION ALL SELECT * FROM ceiling) GROUP BY bound)"


def _actives(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "fx_candidates").where("prediction >= 7.5")


def _refs(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "fx_candidates").where(_REF)


def _window(spark: SparkSession, d: str) -> DataFrame:
    return V.intersect_bounds(V.envelope(_actives(spark, d)), V.reference_ceiling(_refs(spark, d)))


@query("envelope", f"WITH {ENVELOPE} SELECT * FROM env")
def _(spark, d):
    return V.envelope(_actives(spark, d))


@query("ref_ceiling", f"WITH {CEILING} SELECT * FROM ceiling")
def _(spark, d):
    return V.reference_ceiling(_refs(spark, d))


@query("bounds_intersect", f"WITH {BOTH} SELECT * FROM win")
def _(spark, d):
    return _window(spark, d)


WIDE_WINDOW = BOTH + ", w AS (SELECT max(value) FILTER (bound = 'mw_min') AS mw_min, max(value) FILTER (bound = 'mw_max') AS mw_max, max(value) FILTER (bound = 'logp_max') AS logp_max, max(value) FILTER (bound = 'tpsa_max') AS tpsa_max FROM win)"
_TIGHT = 400.0
_WHY = "concat_ws(',', CASE WHEN logp > logp_max THEN 'logp_max' END, CASE WHEN mw > mw_max THEN 'mw_max' END, CASE WHEN mw < mw_min THEN 'mw_min' END, CASE WHEN tpsa > tpsa_max THEN 'tpsa_max' END)"


@query("ref_rejections", f"WITH {WIDE_WINDOW}, inherited AS (SELECT mw_min, least(mw_max, {_TIGHT}) AS mw_max, logp_max, tpsa_max FROM w) SELECT name, {_WHY} AS reasons FROM {{fx_candidates}}, inherited WHERE {_REF} AND {_WHY} <> ''")
def _(spark, d):
    return V.rejections(_refs(spark, d), V.intersect_bounds(_window(spark, d), spark.createDataFrame([("mw_max", _TIGHT)], "bound string, value double")))


@query("check_admits", f"WITH {WIDE_WINDOW}, x AS (SELECT count(*) AS n, count(*) FILTER ({_WHY} <> '') AS bad FROM {{fx_candidates}}, w WHERE {_REF}) SELECT n AS n_references, n - bad AS n_admitted, bad = 0 AND n > 0 AS passed FROM x")
def _(spark, d):
    return V.check_admits(_refs(spark, d), _window(spark, d))


@query("window_compose", f"WITH {BOTH}, more AS (SELECT * FROM win UNION ALL SELECT 'mw_max', 500.0 UNION ALL SELECT 'hbd_max', 5.0) SELECT bound, CASE WHEN bound LIKE '%_max' THEN min(value) ELSE max(value) END AS value FROM more GROUP BY bound")
def _(spark, d):
    return V.intersect_bounds(_window(spark, d), spark.createDataFrame([("mw_max", 500.0), ("hbd_max", 5.0)], "bound string, value double"))


_T = V.Thresholds()
SCREEN = f"""scr AS (SELECT *, round(prediction - {_T.halfwidth}, 3) AS lower, round(prediction + {_T.halfwidth}, 3) AS upper, CASE WHEN sim >= {_T.in_domain} THEN 'S1_in_domain' WHEN sim >= {_T.borderline} THEN 'S2_near_domain' ELSE 'S3_far_novel' END AS stratum,
  CASE WHEN sim < {_T.in_domain} THEN 'abstain_out_of_ad' WHEN prediction + {_T.halfwidth} < {_T.hit_floor} THEN 'qsar_below_hit_floor' WHEN sim >= {_T.high_conf} AND prediction - {_T.halfwidth} >= {_T.fep_lower} AND delta >= {_T.fep_delta} THEN 'fep_first'
  WHEN sim >= {_T.high_conf} AND prediction >= {_T.prio_point} AND delta >= {_T.prio_delta} THEN 'front_of_queue' ELSE 'none' END AS priority, sim >= {_T.known_flag} AS known_reference FROM {{fx_candidates}})"""


def _screened(spark: SparkSession, d: str) -> DataFrame:
    return V.annotate(view(spark, d, "fx_candidates"))


@query("screen_annotate", f"WITH {SCREEN} SELECT id, lower, upper, stratum, priority, known_reference, closest FROM scr")
def _(spark, d):
    return _screened(spark, d).select("id", "lower", "upper", "stratum", "priority", "known_reference", "closest")


def _predicted(rows: DataFrame) -> DataFrame:
    """Stands for a fitted model's transform: functions of the row's bits."""
    n = F.size("bits")
    return rows.withColumns({"prediction": (4 + n % 40 / 8.0).cast("double"), "delta": F.when(F.col("id") % 7 > 0, (n % 9 - 3).cast("double"))})


@query("screen_library", f"""
WITH {SIM}, lib AS (SELECT vec_id AS id, CASE WHEN vec_id % 13 > 0 THEN bits END AS bits FROM {{fx_bits}} WHERE NOT train), e AS (SELECT p.*, g.grp FROM pairs AS p JOIN {{fx_bits}} AS g ON p.r = g.vec_id WHERE NOT qt AND rt),
k AS (SELECT q, max(s) AS m FROM e WHERE r % 10 = 0 GROUP BY q), c AS (SELECT e.q, min(r) AS closest FROM e JOIN k ON e.q = k.q AND e.s = k.m WHERE r % 10 = 0 GROUP BY e.q), a AS (SELECT q, max(s) AS t, max(s) FILTER (grp < 4) AS a FROM e GROUP BY q),
j AS (SELECT id, bits IS NOT NULL AS parsed, CASE WHEN bits IS NOT NULL THEN coalesce(a.t, 0) END AS sim_train, CASE WHEN bits IS NOT NULL THEN coalesce(a.a, 0) END AS sim_actives, CASE WHEN bits IS NOT NULL THEN coalesce(k.m, 0) END AS sim_known,
  CASE WHEN bits IS NOT NULL THEN c.closest END AS closest, CASE WHEN bits IS NOT NULL THEN 4 + len(bits) % 40 / 8.0 END AS prediction, CASE WHEN bits IS NOT NULL AND id % 7 > 0 THEN (len(bits) % 9 - 3)::DOUBLE END AS delta
  FROM lib LEFT JOIN a ON id = a.q LEFT JOIN k ON id = k.q LEFT JOIN c ON id = c.q)
SELECT id, parsed, sim_train, sim_actives, sim_known, closest, prediction, delta, round(prediction - {_T.halfwidth}, 3) AS lower, round(prediction + {_T.halfwidth}, 3) AS upper,
  CASE WHEN NOT parsed THEN 'unparseable' WHEN sim_train >= {_T.in_domain} THEN 'S1_in_domain' WHEN sim_train >= {_T.borderline} THEN 'S2_near_domain' ELSE 'S3_far_novel' END AS stratum,
  CASE WHEN NOT parsed THEN 'unparseable' WHEN sim_train < {_T.in_domain} THEN 'abstain_out_of_ad' WHEN prediction + {_T.halfwidth} < {_T.hit_floor} THEN 'qsar_below_hit_floor' WHEN sim_train >= {_T.high_conf} AND prediction - {_T.halfwidth} >= {_T.fep_lower} AND delta >= {_T.fep_delta} THEN 'fep_first'
  WHEN sim_train >= {_T.high_conf} AND prediction >= {_T.prio_point} AND delta >= {_T.prio_delta} THEN 'front_of_queue' ELSE 'none' END AS priority, coalesce(sim_known >= {_T.known_flag}, false) AS known_reference FROM j""")
def _(spark, d):
    b = _bits(spark, d)
    library = b.where("NOT train").select(F.col("vec_id").alias("id"), F.when(F.col("vec_id") % 13 > 0, F.col("bits")).alias("bits"))
    refs = _reference_sets(b).withColumnRenamed("vec_id", "id")
    return V.screen_library(library, refs, _predicted).drop("bits")


@query("screen_text_ids", f"""
WITH {SIM}, e AS (SELECT p.*, g.grp, concat('ZINC', q) AS qi, concat('REF', r) AS ri FROM pairs AS p JOIN {{fx_bits}} AS g ON p.r = g.vec_id WHERE NOT qt AND rt), k AS (SELECT qi, max(s) AS m FROM e WHERE r % 10 = 0 GROUP BY qi),
c AS (SELECT e.qi, min(ri) AS closest FROM e JOIN k ON e.qi = k.qi AND e.s = k.m WHERE r % 10 = 0 GROUP BY e.qi), a AS (SELECT qi, max(s) AS t, max(s) FILTER (grp < 4) AS a FROM e GROUP BY qi), lib AS (SELECT concat('ZINC', vec_id) AS id, bits FROM {{fx_bits}} WHERE NOT train)
SELECT id, coalesce(a.t, 0) AS sim_train, coalesce(a.a, 0) AS sim_actives, coalesce(k.m, 0) AS sim_known, closest, CASE WHEN coalesce(a.t, 0) >= {_T.in_domain} THEN 'S1_in_domain' WHEN coalesce(a.t, 0) >= {_T.borderline} THEN 'S2_near_domain' ELSE 'S3_far_novel' END AS stratum
FROM lib LEFT JOIN a ON id = a.qi LEFT JOIN k ON id = k.qi LEFT JOIN c ON id = c.qi""")
def _(spark, d):
    """A screen of a library whose ids are texts, as in library files, against references with names of their own kind."""
    b = _bits(spark, d)
    library = b.where("NOT train").select(F.concat(F.lit("ZINC"), "vec_id").alias("id"), "bits")
    refs = _reference_sets(b).withColumn("id", F.concat(F.lit("REF"), "vec_id"))
    said = lambda rows: rows.withColumns({"prediction": F.size("bits").cast("double"), "delta": F.lit(None).cast("double")})
    return V.screen_library(library, refs, said).select("id", "sim_train", "sim_actives", "sim_known", "closest", "stratum")


@query("candidate_head", "SELECT doc_id, pos FROM {fx_library} WHERE key IS NOT NULL ORDER BY pos LIMIT 40")
def _(spark, d):
    """The first candidates of a pool by place: the limit is the operator."""
    return V.head(view(spark, d, "fx_library").where("key IS NOT NULL").select("doc_id", "pos"), 40)


@query("screen_skip", "SELECT 'skipped' AS status, 'enabled=true, library=absent' AS reason UNION ALL SELECT 'ran', NULL FROM (SELECT count(*) AS n FROM {fx_bits} WHERE NOT train) WHERE n > 0")
def _(spark, d):
    library = _bits(spark, d).where("NOT train")
    none, _ = V.screen_or_skip(True, library.where("vec_id < 0"), lambda x: x, spark)
    return none.unionByName(V.screen_or_skip(True, library, lambda x: x, spark)[0])


@query("ceiling_notes", f"SELECT count(*) AS n_references, CASE WHEN count(*) > 0 THEN round(0.15 * (1 + 2.0 / sqrt(count(*))), 4) ELSE 0.15 END AS margin, CASE WHEN count(*) = 0 THEN 'no references: no ceiling can be derived' WHEN count(*) < 4 THEN concat('only ', count(*), ' references: the ceiling is weakly determined') END AS caveat FROM {{fx_candidates}} WHERE {_REF}")
def _(spark, d):
    return V.ceiling_notes(_refs(spark, d))


@query("priority_label", f"WITH {SCREEN} SELECT priority, delta IS NULL AS no_delta, count(*) AS n FROM scr GROUP BY 1, 2")
def _(spark, d):
    return _screened(spark, d).groupBy("priority", F.col("delta").isNull().alias("no_delta")).agg(F.count("*").alias("n"))


@query("strata_census", f"WITH {SCREEN}, k AS (SELECT unnest(['fep_first', 'front_of_queue', 'none', 'qsar_below_hit_floor', 'abstain_out_of_ad']) AS name) SELECT k.name, count(scr.id) AS n FROM k LEFT JOIN scr ON k.name = priority GROUP BY k.name")
def _(spark, d):
    return V.census(_screened(spark, d), "priority", V.PRIORITIES)


@query("per_stratum", f"WITH {SCREEN}, b AS (SELECT stratum, count(*) AS n, round(median(sim), 6) AS median_sim, round(median(prediction), 6) AS median_prediction FROM scr GROUP BY stratum) SELECT stratum, priority, count(*) AS n_label, any_value(b.n) AS n, any_value(median_sim) AS median_sim, any_value(median_prediction) AS median_prediction FROM scr JOIN b USING (stratum) GROUP BY stratum, priority")
def _(spark, d):
    return V.per_stratum(_screened(spark, d))


@query("similarity_summary", "SELECT count(*) AS n, round(quantile_cont(sim, 0.5), 6) AS median, round(quantile_cont(sim, 0.9), 6) AS p90, round(quantile_cont(sim, 0.99), 6) AS p99, max(sim) AS max, count(*) FILTER (sim >= 0.65) AS n_known FROM {fx_candidates} WHERE sim IS NOT NULL")
def _(spark, d):
    return V.similarity_summary(view(spark, d, "fx_candidates"))


@query("top_anchors", "SELECT id, prediction FROM {fx_candidates} WHERE prediction >= 7.5 ORDER BY prediction DESC, id LIMIT 25")
def _(spark, d):
    return V.top_anchors(view(spark, d, "fx_candidates"), 7.5).select("id", "prediction")


@query("review_top", f"WITH {SCREEN} SELECT id, sim, priority FROM scr WHERE known_reference ORDER BY sim DESC, id LIMIT 200")
def _(spark, d):
    return V.review_list(_screened(spark, d)).select("id", "sim", "priority")


# scores ---------------------------------------------------------------------------------------------------------------

SPEC = [G.Component("prediction", "sigmoid", 2.0, {"center": 7.0}), G.Component("delta", "sigmoid", 1.0, {"center": 1.0, "k": 2.0}), G.Component("mw", "double_sigmoid", 1.0, {"low": 250, "high": 450, "k": 0.05}),
        G.Component("tpsa", "reverse_sigmoid", 0.5, {"center": 90, "k": 0.1}), G.Component("sim", "sigmoid", 1.0, {"center": 0.5, "k": 8.0})]
_sig = lambda x, c, k: f"(1 / (1 + exp(-{k} * ({x} - {c}))))"
_PARTS = {"prediction": _sig("prediction", 7.0, 1.0), "delta": _sig("delta", 1.0, 2.0), "mw": f"({_sig('mw', 250, 0.05)} * (1 - {_sig('mw', 450, 0.05)}))", "tpsa": f"(1 - {_sig('tpsa', 90, 0.1)})", "sim": _sig("sim", 0.5, 8.0)}
SCORED = "sc AS (SELECT *, " + ", ".join(f"coalesce({e}, 0) AS s_{n}" for n, e in _PARTS.items()) + " FROM {fx_candidates}), agg AS (SELECT *, round((" + " + ".join(f"{c.weight} * s_{c.name}" for c in SPEC) + f") / {sum(c.weight for c in SPEC)}, 9) AS score_sum, round(exp((" + " + ".join(f"{c.weight} * ln(least(greatest(s_{c.name}, 1e-9), 1))" for c in SPEC) + f") / {sum(c.weight for c in SPEC)}), 9) AS score_geo FROM sc)"


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return G.scored(view(spark, d, "fx_candidates"), G.checked(SPEC, ["prediction", "delta", "mw", "tpsa", "sim"], ("delta",)))


@query("transforms", f"WITH {SCORED} SELECT id, " + ", ".join(f"round(s_{c.name}, 6) AS s_{c.name}" for c in SPEC) + " FROM agg")
def _(spark, d):
    return _scored(spark, d).select("id", *[F.round(f"s_{c.name}", 6).alias(f"s_{c.name}") for c in SPEC])


@query("score_components", "SELECT id, round(prediction, 6) AS prediction, round(delta, 6) AS delta, mw, tpsa, round(1 - sim, 6) AS distance FROM {fx_candidates}")
def _(spark, d):
    return G.component_vector(view(spark, d, "fx_candidates"), ("prediction", "delta", "mw", "tpsa"))


@query("aggregate_scores", f"WITH {SCORED} SELECT id, score_sum, score_geo FROM agg")
def _(spark, d):
    return _scored(spark, d).select("id", "score_sum", "score_geo")


ARMS = SCORED + ", arms AS (SELECT * FROM (SELECT 'score_sum' AS arm, row_number() OVER (ORDER BY score_sum DESC, id) AS rank, id, sim, score_sum AS score FROM agg) WHERE rank <= 20 UNION ALL SELECT * FROM (SELECT 'score_geo', row_number() OVER (ORDER BY score_geo DESC, id) AS rank, id, sim, score_geo FROM agg) WHERE rank <= 20)"


@query("two_arm_topk", f"WITH {ARMS} SELECT arm, rank::INT AS rank, id, round(score, 6) AS score FROM arms")
def _(spark, d):
    return rounded(G.two_arms(_scored(spark, d), 20), "score")


@query("arm_summary", f"WITH {ARMS} SELECT arm, count(*) AS n, round(avg(1 - sim), 6) AS mean_distance FROM arms GROUP BY arm")
def _(spark, d):
    s = _scored(spark, d)
    return G.arm_summary(G.two_arms(s, 20), s)


@query("acquire", f"WITH {SCORED} (SELECT 'exploit' AS mode, id FROM agg ORDER BY score_geo DESC, id LIMIT 10) UNION ALL (SELECT 'explore', id FROM agg ORDER BY sim, id LIMIT 10)")
def _(spark, d):
    s = _scored(spark, d)
    return G.acquire(s, 10).select(F.lit("exploit").alias("mode"), "id").unionByName(G.acquire(s, 10, "explore").select(F.lit("explore").alias("mode"), "id"))


@query("acq_rounds", f"""
WITH {SCORED}, r0 AS (SELECT id, score_geo FROM agg ORDER BY score_geo DESC, id LIMIT 8), r1 AS (SELECT id, score_geo FROM agg WHERE id NOT IN (SELECT id FROM r0) ORDER BY sim, id LIMIT 8),
r2 AS (SELECT id, score_geo FROM agg WHERE id NOT IN (SELECT id FROM r0) AND id NOT IN (SELECT id FROM r1) ORDER BY score_geo DESC, id LIMIT 8),
h AS (SELECT 0 AS round, * FROM r0 UNION ALL SELECT 1, * FROM r1 UNION ALL SELECT 2, * FROM r2) SELECT h.round, h.id, round(h.score_geo, 6) AS score_geo, CASE WHEN h.id % 3 > 0 THEN h.id % 10 / 2.0 END AS measured FROM h""")
def _(spark, d):
    s = _scored(spark, d).select("id", "score_geo", "sim")
    known = s.where("id % 3 > 0").select("id", (F.col("id") % 10 / 2.0).alias("measured"))
    return rounded(G.acquisition_rounds(s, known, 3, 8), "score_geo")


@query("round_trace", f"""
WITH {SCORED}, r0 AS (SELECT id, score_geo FROM agg ORDER BY score_geo DESC, id LIMIT 8), r1 AS (SELECT id, score_geo FROM agg WHERE id NOT IN (SELECT id FROM r0) ORDER BY sim, id LIMIT 8),
h AS (SELECT 0 AS round, * FROM r0 UNION ALL SELECT 1, * FROM r1) SELECT round, count(*) AS n, round(avg(score_geo), 6) AS mean_score, round(avg(CASE WHEN id % 3 > 0 THEN id % 10 / 2.0 END), 6) AS mean_measured FROM h GROUP BY round""")
def _(spark, d):
    s = _scored(spark, d).select("id", "score_geo", "sim")
    return G.round_trace(G.acquisition_rounds(s, s.where("id % 3 > 0").select("id", (F.col("id") % 10 / 2.0).alias("measured")), 2, 8))


@query("ordered_left_score", """
WITH s AS (SELECT concat('K', p_partkey) AS key, avg(p_size)::DOUBLE AS score FROM part WHERE p_size > 10 GROUP BY p_partkey)
SELECT l_orderkey * 10 + l_linenumber AS pos, concat('K', l_partkey) AS key, coalesce(s.score, 0) AS score FROM lineitem LEFT JOIN s ON concat('K', l_partkey) = s.key ORDER BY pos""")
def _(spark, d):
    inputs = view(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"), F.concat(F.lit("K"), "l_partkey").alias("key"))
    scores = view(spark, d, "part").where("p_size > 10").groupBy(F.concat(F.lit("K"), "p_partkey").alias("key")).agg(F.avg("p_size").alias("score"))  # what could be scored
    return G.ordered_scores(inputs, scores)


# features, records, text, space ---------------------------------------------------------------------------------------


@query("descriptors", r"SELECT doc_id, length(text)::BIGINT AS n_chars, len(string_split(text, chr(10)))::BIGINT AS n_lines, len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''))::BIGINT AS n_words, (length(text) - length(regexp_replace(text, '[0-9]', '', 'g')))::BIGINT AS n_digits FROM documents")
def _(spark, d):
    return view(spark, d, "documents").select("doc_id", *S.descriptors("text", ["n_chars", "n_lines", "n_words", "n_digits"]))


@query("group_key", "SELECT doc_id, coalesce(nullif(CASE WHEN doc_id % 5 = 0 THEN '' WHEN doc_id % 7 = 0 THEN NULL ELSE source END, ''), concat('D', doc_id)) AS grp FROM documents")
def _(spark, d):
    n = F.col("doc_id")
    g = F.when(n % 5 == 0, "").when(n % 7 == 0, None).otherwise(F.col("source"))
    return view(spark, d, "documents").select("doc_id", S.group_key(g, F.concat(F.lit("D"), n)).alias("grp"))


@query("status_census", "WITH k AS (SELECT unnest(['click', 'view', 'purchase', 'lost']) AS name) SELECT k.name, count(e.event_id) AS n FROM k LEFT JOIN events AS e ON e.event_type = k.name GROUP BY k.name")
def _(spark, d):
    return V.census(view(spark, d, "events"), "event_type", ("click", "view", "purchase", "lost"))


@query("status_sums", "SELECT count(*) AS jobs, count(*) FILTER (event_type = 'purchase') AS ok, round(sum(value) FILTER (event_type = 'purchase'), 4) AS score, sum(CAST(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS seconds FROM events")
def _(spark, d):
    return V.outcome_sums(view(spark, d, "events"), "event_type", "purchase", "value", F.get_json_object("props", "$.k").cast("bigint"))


@query("metric_diff", """
WITH j AS (SELECT coalesce(a.path, b.path) AS path, a.value AS va, b.value AS vb, a.path IS NULL AS na, b.path IS NULL AS nb FROM {fx_metrics_a} AS a FULL JOIN {fx_metrics_b} AS b ON a.path = b.path),
k AS (SELECT path, CASE WHEN nb THEN 'missing' WHEN na THEN 'extra' WHEN (va IS NULL) <> (vb IS NULL) THEN 'null' WHEN abs(va - vb) > 1e-9 * greatest(abs(va), abs(vb)) THEN 'value' END AS kind, round(abs(va - vb), 6) AS gap FROM j) SELECT * FROM k WHERE kind IS NOT NULL""")
def _(spark, d):
    return R.metric_diff(view(spark, d, "fx_metrics_a"), view(spark, d, "fx_metrics_b"))


_CUSTOMERS = "SELECT n_nationkey AS k, n_name AS nation, c_mktsegment AS segment, count(c_custkey) AS n, CAST(round(coalesce(sum(c_acctbal), 0), 2) AS DOUBLE) AS balance FROM {nation} LEFT JOIN {customer} ON c_nationkey = n_nationkey GROUP BY n_nationkey, n_name, c_mktsegment"
_LEAF_SQL = """s AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY segment NULLS FIRST) - 1 AS i FROM ({customers}) AS c),
a AS (SELECT k, nation, 'name' AS path, NULL::DOUBLE AS value, NULL::BOOLEAN AS flag, nation AS text FROM s WHERE i = 0 UNION ALL SELECT k, nation, concat('segments[', i, '].segment'), NULL, NULL, segment FROM s
  UNION ALL SELECT k, nation, concat('segments[', i, '].n'), n, NULL, NULL FROM s UNION ALL SELECT k, nation, concat('segments[', i, '].checks.balance'), balance, NULL, NULL FROM s UNION ALL SELECT k, nation, concat('segments[', i, '].checks.large'), NULL, n > 2, NULL FROM s),
b AS (SELECT k, nation, path, CASE WHEN k % 5 = 1 AND path LIKE '%.balance' THEN value + 1 ELSE value END AS value, CASE WHEN k % 5 = 3 AND path LIKE 'segments[0]%' THEN NOT flag ELSE flag END AS flag,
  CASE WHEN k % 5 = 2 AND path LIKE '%.segment' THEN concat(text, '!') ELSE text END AS text FROM a WHERE k % 5 <> 4 OR path <> 'name')"""


def _nation_records(spark: SparkSession, d: str, other: bool) -> DataFrame:
    """A nested record a nation: its name, and an array of its customers' segments. The other run's records differ by rules on the nation's number."""
    k = F.col("k")
    # customers are counted before they meet their nations, so that a join broadcasts a row a segment, not all of them
    counted = view(spark, d, "customer").groupBy("c_nationkey", F.col("c_mktsegment").alias("segment")).agg(F.count("c_custkey").alias("n"), F.sum("c_acctbal").alias("balance"))
    nation = view(spark, d, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("nation"))
    rows = nation.join(counted, F.col("k") == F.col("c_nationkey"), "left").select("k", "nation", "segment", F.coalesce("n", F.lit(0)).alias("n"), F.round(F.coalesce("balance", F.lit(0)), 2).cast("double").alias("balance"))
    own = F.row_number().over(Window.partitionBy("k").orderBy(F.col("segment").asc_nulls_first()))
    rows = rows.withColumn("first", own == 1)
    change = lambda rule, then, other_: F.when(F.lit(other) & (k % 5 == rule), then).otherwise(other_)
    segment = F.struct(
        F.col("first"), F.coalesce(F.col("segment"), F.lit("")).alias("order"), change(2, F.concat("segment", F.lit("!")), F.col("segment")).alias("segment"), "n",
        F.struct(change(1, F.col("balance") + 1, F.col("balance")).alias("balance"), F.when(F.lit(other) & (k % 5 == 3) & F.col("first"), F.col("n") <= 2).otherwise(F.col("n") > 2).alias("large")).alias("checks"),
    )
    made = rows.groupBy("k", "nation").agg(F.transform(F.array_sort(F.collect_list(F.struct((~F.col("first")).alias("later"), F.coalesce("segment", F.lit("")).alias("at"), segment.alias("s")))), lambda x: x["s"].dropFields("first", "order")).alias("segments"))
    name = F.when(F.lit(other) & (k % 5 == 4), F.lit(None).cast("string")).otherwise(F.col("nation"))
    full = F.to_json(F.struct(name.alias("name"), "segments"), {"ignoreNullFields": "false"})
    return made.select("nation", F.when(F.lit(other) & (k % 5 == 4), F.to_json(F.struct("segments"), {"ignoreNullFields": "false"})).otherwise(full).alias("record"))


@query("record_leaves", f"WITH {_LEAF_SQL.replace('{customers}', _CUSTOMERS)} SELECT nation, path, value, flag, text FROM a")
def _(spark, d):
    return R.leaves(_nation_records(spark, d, False), by=("nation",))


@query("record_diff", f"""WITH {_LEAF_SQL.replace('{customers}', _CUSTOMERS)} SELECT coalesce(a.nation, b.nation) AS nation, coalesce(a.path, b.path) AS path,
  CASE WHEN b.path IS NULL THEN 'missing' WHEN a.path IS NULL THEN 'extra' WHEN a.flag IS DISTINCT FROM b.flag THEN 'bool' ELSE 'value' END AS kind, round(abs(a.value - b.value), 6) AS gap
FROM a FULL JOIN b ON a.k = b.k AND a.path = b.path WHERE a.path IS NULL OR b.path IS NULL OR a.flag IS DISTINCT FROM b.flag OR a.text IS DISTINCT FROM b.text OR abs(a.value - b.value) > 1e-9 * greatest(abs(a.value), abs(b.value))""")
def _(spark, d):
    """Nested records of two runs, a pair a nation: numbers, flags and texts inside arrays, and a name that is gone."""
    one, two = (R.leaves(_nation_records(spark, d, other), by=("nation",)) for other in (False, True))
    return R.metric_diff(one, two, flag="flag", text="text", by=("nation",))


@query("family_gaps", "SELECT split_part(a.path, '.', 1) AS family, count(*) AS n, round(max(abs(a.value - b.value)), 6) AS max_gap FROM {fx_metrics_a} AS a JOIN {fx_metrics_b} AS b ON a.path = b.path GROUP BY 1")
def _(spark, d):
    return R.family_gaps(view(spark, d, "fx_metrics_a"), view(spark, d, "fx_metrics_b"))


@query("table_digest", "WITH m AS (SELECT md5(concat_ws('|', p_partkey, p_name, p_brand, p_type, p_size)) AS h FROM part) SELECT count(*) AS n, sum(CAST('0x' || h[1:8] AS BIGINT))::VARCHAR AS high, sum(CAST('0x' || h[9:16] AS BIGINT))::VARCHAR AS low FROM m")
def _(spark, d):
    return R.table_digest(view(spark, d, "part"), ["p_partkey", "p_name", "p_brand", "p_type", "p_size"])


# braces of patterns are set aside while views' placeholders are filled in
_q = lambda s: s.replace("'", "''")
_HIDDEN = "chr(1)"  # stands for the exempt host, so that the e-mail shape needs no look-ahead
_TOKENS = r"list_filter(regexp_extract_all(line, '(?:^|[^A-Za-z0-9])([A-Za-z]{2,6}[_-][A-Za-z0-9]{28,})', 1), lambda t: regexp_matches(t, '[_-][A-Za-z0-9]*[0-9]'))"


def _shape_sql(p: L.Pattern) -> str:
    """SQL of one shape's findings in `li`."""
    keys = f"SELECT doc_id, line_no, '{p.name}' AS name, '{p.severity}' AS severity"
    if p.name == "non-noreply-email":
        plain = _q(p.expr.replace(r"(?!users\.noreply\.)", ""))
        line = f"replace(line, '@users.noreply.', {_HIDDEN})"
        return f"{keys}, substr(replace(regexp_replace({line}, '{plain}', '{L.MASK}', 'g'), {_HIDDEN}, '@users.noreply.'), 1, 100) AS snippet FROM li WHERE regexp_matches({line}, '{plain}')"
    if p.name == "opaque-token":
        masked = f"list_reduce(list_prepend(line, {_TOKENS}), lambda a, t: replace(a, t, '{L.MASK}'))"
        return f"{keys}, substr({masked}, 1, 100) AS snippet FROM li WHERE len({_TOKENS}) > 0"
    return f"{keys}, substr(regexp_replace(line, '{_q(p.expr)}', '{L.MASK}', 'g'), 1, 100) AS snippet FROM li WHERE regexp_matches(line, '{_q(p.expr)}')"


_SCAN = " UNION ALL ".join(_shape_sql(p) for p in L.PATTERNS)
SCAN = "li AS (SELECT doc_id, i AS line_no, l[i] AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents) AS s, unnest(range(1, len(l) + 1)) AS u(i)), found AS (" + _SCAN.replace("{", "\0").replace("}", "\1") + ")"


def _findings(spark: SparkSession, d: str) -> DataFrame:
    return L.scan(L.lines(view(spark, d, "documents")))


@query("pattern_scan", f"WITH {SCAN} SELECT doc_id, line_no::INT AS line_no, name, severity, snippet FROM found")
def _(spark, d):
    return _findings(spark, d)


@query("pattern_summary", f"WITH {SCAN} SELECT severity, name, count(*) AS hits, count(DISTINCT doc_id) AS docs FROM found GROUP BY severity, name")
def _(spark, d):
    return L.summary(_findings(spark, d))


@query("mask_email", r"SELECT doc_id, md5(regexp_replace(text, '([A-Za-z0-9])[^@\s]*@([A-Za-z0-9])\S*', '\1***@\2***', 'g')) AS masked FROM documents")
def _(spark, d):
    return view(spark, d, "documents").select("doc_id", F.md5(S.masked_address(F.col("text"))).alias("masked"))


BOX = """bx AS (SELECT entry, grp, count(*) AS n, round(avg(x), 6) AS cx, round(greatest(20, max(x) - min(x) + 8), 6) AS sx, round(avg(y), 6) AS cy, round(greatest(20, max(y) - min(y) + 8), 6) AS sy, round(avg(z), 6) AS cz, round(greatest(20, max(z) - min(z) + 8), 6) AS sz FROM {fx_points} GROUP BY entry, grp),
box AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entry ORDER BY n DESC, grp) AS k FROM bx) WHERE k = 1)"""


@query("group_box", f"WITH {BOX} SELECT entry, grp, n, cx, sx, cy, sy, cz, sz FROM box")
def _(spark, d):
    return X.group_box(view(spark, d, "fx_points"))


@query("box_qa", f"""
WITH {BOX}, i AS (SELECT p.entry, b.grp AS box_group, p.grp = b.grp AS own, abs(x - cx) <= sx / 2 AND abs(y - cy) <= sy / 2 AND abs(z - cz) <= sz / 2 AS inn FROM {{fx_points}} AS p JOIN box AS b ON p.entry = b.entry),
q AS (SELECT entry, box_group, count(*) FILTER (own) AS n_own, round(count(*) FILTER (own AND inn) / count(*) FILTER (own), 6) AS inside, count(*) FILTER (NOT own AND inn) AS n_others_inside FROM i GROUP BY entry, box_group)
SELECT *, concat_ws(',', CASE WHEN inside < 0.9 THEN 'group outside box' END, CASE WHEN n_own < 3 THEN 'few points' END, CASE WHEN n_others_inside = 0 THEN 'nothing around' END) AS failed FROM q""")
def _(spark, d):
    p = view(spark, d, "fx_points")
    return X.box_qa(p, X.group_box(p))


@query("radius_semijoin", "SELECT vec_id FROM {fx_points} AS p WHERE EXISTS (SELECT 1 FROM {fx_points} AS c WHERE c.grp = 0 AND c.entry = p.entry AND (p.x - c.x) * (p.x - c.x) + (p.y - c.y) * (p.y - c.y) + (p.z - c.z) * (p.z - c.z) <= 9) AND grp <> 0")
def _(spark, d):
    p = view(spark, d, "fx_points")
    return X.within_radius(p.where("grp <> 0"), p.where("grp = 0"), 3.0).select("vec_id")


@query("ref_rank", "SELECT id, similarity FROM (SELECT p_partkey AS id, CASE WHEN p_partkey % 50 = 0 THEN 1.0 ELSE (p_partkey % 97) / 100.0 END::DOUBLE AS similarity, CASE WHEN p_size > 5 THEN p_size::DOUBLE END AS resolution FROM part) ORDER BY similarity >= 0.999 DESC, coalesce(resolution, 99), similarity DESC, id")
def _(spark, d):
    n = F.col("p_partkey")
    rows = view(spark, d, "part").select(n.alias("id"), F.when(n % 50 == 0, 1.0).otherwise(n % 97 / 100.0).alias("similarity"), F.when(F.col("p_size") > 5, F.col("p_size").cast("double")).alias("resolution"))
    return X.preference(rows).select("id", "similarity")


# models (fits have no SQL; tests hold them to invariants) ---------------------------------------------------------------


@query("rf_fit")
def _(spark, d):
    return M.regression(ML.forest_by_sums(P.group_folds(view(spark, d, "fx_rows")), ("x",)), "fold")


@query("ridge_bits")
def _(spark, d):
    b = _bits(spark, d).select("vec_id", "bits", "train", F.col("grp").cast("double").alias("y"))
    rows = ML.with_features(b, "bits", 64)
    train = rows.where("train")
    return M.regression(ML.ridge(train).fit(train).transform(rows.where("NOT train")))


@query("boosted_fit")
def _(spark, d):
    rows = view(spark, d, "fx_rows").withColumn("test", P.is_test("id"))
    return M.regression(ML.boosted_by_sums(rows, ("x",), rounds=10, depth=3))


# landed files and streams, from tables that Spark lands first --------------------------------------------------------------


@query("snapshot_verify", "SELECT n.n_name AS name, CASE WHEN n.n_nationkey % 5 = 0 THEN 'missing' WHEN n.n_nationkey % 5 = 1 THEN 'mismatch' ELSE 'ok' END AS status FROM nation AS n UNION ALL SELECT 'extra', 'unlisted'")
def _(spark, d):
    """One digest per nation's customers (sums of row hashes, in any order), against sums of which some are absent, wrong or of nothing."""
    nation, customer = view(spark, d, "nation"), view(spark, d, "customer")
    rows = customer.groupBy("c_nationkey").agg(F.sum(F.xxhash64("c_custkey").cast("decimal(38,0)")).alias("h"), F.count("*").alias("n"))
    found = nation.join(rows, rows["c_nationkey"] == nation["n_nationkey"], "left").select("n_nationkey", "n_name", F.sha2(F.concat_ws("|", F.coalesce("h", F.lit(0)).cast("string"), F.coalesce("n", F.lit(0)).cast("string")), 256).alias("sha256"))
    sums = found.select(F.col("n_name").alias("name"), F.when(F.col("n_nationkey") % 5 == 1, F.sha2("sha256", 256)).otherwise(F.col("sha256")).alias("sha256"))
    there = found.where("n_nationkey % 5 <> 0").select(F.col("n_name").alias("name"), "sha256").union(nation.limit(1).select(F.lit("extra"), F.lit("0")))
    return IO.verify_snapshot(there, sums)


_FILE_SQL = "f AS (SELECT n_nationkey AS k, sha256(string_agg(concat(c_custkey, ',', c_name), chr(10) ORDER BY c_custkey) || chr(10)) AS sha256, sum(octet_length(encode(concat(c_custkey, ',', c_name))) + 1)::BIGINT AS bytes FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey)"


def _nation_files(spark: SparkSession, d: str) -> DataFrame:
    """(k, bytes, sha256) of files on disk, one with each nation's customers in order."""
    folder = fresh_folder(spark, "snapshot")
    rows = view(spark, d, "customer").where("c_nationkey IS NOT NULL").select(F.col("c_nationkey").alias("k"), "c_custkey", F.concat_ws(",", "c_custkey", "c_name").alias("value"))
    rows.repartition("k").sortWithinPartitions("k", "c_custkey").select("k", "value").write.partitionBy("k").text(folder)
    return IO.file_digests(spark, folder, "part-*", by_path=True).select(F.regexp_extract("name", "/k=([0-9]+)/", 1).cast("int").alias("k"), "bytes", "sha256")


@query("snapshot_files", f"WITH {_FILE_SQL} SELECT k, bytes, sha256 FROM f")
def _(spark, d):
    """Digests of files' bytes, read in parts inside tasks."""
    return _nation_files(spark, d)


@query("snapshot_status", f"WITH {_FILE_SQL} SELECT n_nationkey::VARCHAR AS name, CASE WHEN n_nationkey % 5 = 0 THEN 'unlisted' WHEN n_nationkey % 5 = 1 THEN 'mismatch' ELSE 'ok' END AS status FROM nation JOIN f ON k = n_nationkey UNION ALL SELECT 'gone', 'missing'")
def _(spark, d):
    """Files' digests against a list of sums that lacks some files, is wrong about others and names one that is not there."""
    found = _nation_files(spark, d).select(F.col("k").cast("string").alias("name"), "sha256", "k")
    sums = found.where("k % 5 <> 0").select("name", F.when(F.col("k") % 5 == 1, F.sha2("sha256", 256)).otherwise(F.col("sha256")).alias("sha256"))
    gone = view(spark, d, "region").limit(1).select(F.lit("gone").alias("name"), F.lit("0").alias("sha256"))
    return IO.verify_snapshot(found.drop("k"), sums.unionByName(gone))


@query("shard_manifest", "SELECT count(*) AS lines, sum(octet_length(encode(url)) + 1)::BIGINT AS bytes FROM pages")
def _(spark, d):
    folder = fresh_folder(spark, "shards")
    view(spark, d, "pages").select("url").write.text(folder)
    _, manifest = IO.merge_shards(spark, folder, "part-*")
    return manifest.where("name = 'MERGED'").select("lines", "bytes")


@query("library_scan", "SELECT count(*) AS n, sum(pos)::BIGINT AS places, count(*) FILTER (id = concat('row', pos)) AS unnamed FROM (SELECT page_id AS pos, CASE WHEN page_id % 5 = 0 THEN concat('row', page_id) ELSE concat('id', page_id) END AS id FROM pages WHERE page_id % 7 <> 0)")
def _(spark, d):
    """A deck written in page order, with blank lines that count and ids that are missing."""
    folder = fresh_folder(spark, "deck")
    n = F.col("page_id")
    line = F.when(n % 7 == 0, "").when(n % 5 == 0, F.concat(F.lit("k"), n)).otherwise(F.concat(F.lit("k"), n, F.lit(" id"), n))
    view(spark, d, "pages").orderBy("page_id").select(line.alias("value")).write.text(folder)
    return IO.read_library(spark, folder).agg(F.count("*").alias("n"), F.sum("pos").alias("places"), F.count_if(F.col("id") == F.concat(F.lit("row"), "pos")).alias("unnamed"))


@query("two_col_slice", "SELECT page_id AS pos, concat('ZINC', page_id) AS id, split_part(url, '/', 3) AS key FROM pages WHERE page_id >= 20 AND page_id < 120")
def _(spark, d):
    folder = fresh_folder(spark, "deck")
    line = F.concat_ws(" ", F.concat(F.lit("ZINC"), "page_id"), F.split("url", "/")[2])
    view(spark, d, "pages").orderBy("page_id").select(line.alias("value")).write.option("compression", "gzip").text(folder)
    return IO.read_two_columns(spark, folder, "ZINC", 20, 100)


@query("indexed_slice", "SELECT page_id AS pos, concat('ZINC', page_id) AS id FROM pages WHERE page_id >= 40")
def _(spark, d):
    """Lines from number 40 on, by an index of the files: those before them are not read."""
    folder = fresh_folder(spark, "deck")
    line = F.concat_ws(" ", F.concat(F.lit("ZINC"), "page_id"), F.split("url", "/")[2])
    view(spark, d, "pages").repartitionByRange(8, "page_id").sortWithinPartitions("page_id").select(line.alias("value")).write.text(folder)
    return IO.read_two_columns(spark, folder, "ZINC", 40, index=kept(IO.line_index(spark, folder), "index")).select("pos", "id")


@query("stream_ingest", "SELECT event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY event_type")
def _(spark, d):
    folder = fresh_folder(spark, "stream")
    events = view(spark, d, "events")
    events.repartitionByRange(4, "event_id").write.parquet(f"{folder}/in")
    ingest(spark, f"{folder}/in", events.schema, f"{folder}/out", f"{folder}/checkpoint", "parquet")
    return spark.read.parquet(f"{folder}/out").groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("value"))


STREAMED = r"k AS (SELECT min(pos) AS pos, key FROM {fx_library} WHERE key IS NOT NULL GROUP BY key), f AS (SELECT l.*, CASE WHEN NOT size BETWEEN 200 AND 5000 THEN 'physchem' WHEN regexp_matches(l.key, 'licen[sc]e|!!') THEN 'alert' ELSE 'kept' END AS reason FROM {fx_library} AS l JOIN k ON l.pos = k.pos AND l.key = k.key)"


@query("stream_screen", f"WITH {STREAMED} SELECT doc_id, reason FROM f")
def _(spark, d):
    """The library's filters on blocks in the order of `pos`: the same first rows and reasons as the batch job."""
    folder = fresh_folder(spark, "stream")
    library = view(spark, d, "fx_library").where("key IS NOT NULL").select("doc_id", "key", "size", "pos")
    low, high = library.agg(F.min("pos"), F.max("pos")).first()
    reason = F.lit("kept")
    for name, bad in reversed(_fails()):
        reason = F.when(F.coalesce(bad, F.lit(True)), name).otherwise(reason)
    for k in range(3):  # each third lands after the stream has stopped, and is screened by a stream that starts again
        part = F.floor((F.col("pos") - (low or 0)) * 3 / ((high or 0) - (low or 0) + 1)) == k
        library.where(part).write.mode("append").parquet(f"{folder}/in")
        screen_blocks(spark, f"{folder}/in", library.schema, lambda b: b.withColumn("reason", reason), f"{folder}/out", f"{folder}/checkpoint", files_at_once=1_000_000)
    return spark.read.parquet(f"{folder}/out").select("doc_id", "reason")
