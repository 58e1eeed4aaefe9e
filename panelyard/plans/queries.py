"""Queries by name, each an operator applied to the star-schema tables, and their SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelyard.functions import scalars as S
from panelyard.operators import cohort as H
from panelyard.operators import curate as C
from panelyard.operators import metrics as M
from panelyard.operators import models as ML
from panelyard.operators import records as R
from panelyard.operators import scoring as G
from panelyard.operators import screen as V
from panelyard.operators import similarity as N
from panelyard.operators import spatial as X
from panelyard.operators import splits as P
from panelyard.operators import support as A
from panelyard.operators import textscan as L
from panelyard.plans.fixtures import CUTOFF, bucket, oracle, view
from panelyard.sources import readers as IO

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
PRIMARY, COMPARATORS = "T0", ["T1", "T2", "T3"]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = oracle(sql).replace("\0", "{").replace("\1", "}")
        return f

    return add


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


# curation -------------------------------------------------------------------------------------------------------------


def _curated(spark: SparkSession, d: str) -> DataFrame:
    return C.curated_rows(view(spark, d, "fx_activity"))


def _panel(spark: SparkSession, d: str, cutoff: int | None = None) -> DataFrame:
    return C.panel(_curated(spark, d), cutoff)


PANEL = "panel AS (SELECT target, structure, median(label) AS label, count(*) AS n FROM {fx_curatable} GROUP BY target, structure)"
WIDE = PANEL + """, wide AS (SELECT structure, max(label) FILTER (target = 'T0') AS T0, max(label) FILTER (target = 'T1') AS T1, max(label) FILTER (target = 'T2') AS T2, max(label) FILTER (target = 'T3') AS T3 FROM panel GROUP BY structure)"""


@query("src_project_types", "SELECT l_orderkey, l_linenumber, l_shipmode_absent FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag IN ('A', 'R') THEN l_returnflag END AS l_shipmode_absent FROM lineitem) WHERE l_shipmode_absent IS NOT NULL".replace("l_shipmode_absent", "l_returnflag"))
def _(spark, d):
    return IO.project_fields(view(spark, d, "lineitem"), ("l_orderkey", "l_linenumber", "l_returnflag", "not_there"), ("a", "R"), "l_returnflag")


@query("completeness_gate", """
WITH e AS (SELECT concat('T', o_orderkey % 5) AS target, count(*) * 4 AS expected FROM orders GROUP BY 1), l AS (SELECT target, count(*) AS landed FROM {fx_activity} GROUP BY target)
SELECT coalesce(e.target, l.target) AS target, expected, coalesce(landed, 0) AS landed, CASE WHEN expected IS NULL THEN 'undeclared' WHEN landed IS NULL THEN 'absent' WHEN landed = expected THEN 'ok' ELSE 'mismatch' END AS status FROM e FULL JOIN l ON e.target = l.target""")
def _(spark, d):
    declared = view(spark, d, "orders").groupBy(F.concat(F.lit("T"), F.col("o_orderkey") % 5).alias("target")).agg((F.count("*") * 4).alias("expected"))
    return R.completeness(view(spark, d, "fx_activity"), declared)


@query("input_identity", """
SELECT file, count(DISTINCT sha256) AS digests, count(*) AS entries FROM (SELECT concat(p_brand, p_size) AS file, concat(p_type, p_size % 2) AS sha256 FROM part) GROUP BY file HAVING count(DISTINCT sha256) > 1""")
def _(spark, d):
    return R.input_identity(view(spark, d, "part").select(F.concat("p_brand", "p_size").alias("file"), F.concat("p_type", F.col("p_size") % 2).alias("sha256")))


@query("two_col_scan", """
SELECT CASE WHEN page_id % 2 = 0 THEN concat('ZINC', page_id) ELSE concat('zinc', page_id) END AS id, split_part(url, '/', 3) AS key FROM pages WHERE page_id % 11 <> 0""")
def _(spark, d):
    key, n = F.split("url", "/")[2], F.col("page_id")
    line = F.when(n % 11 == 0, key).when(n % 2 == 0, F.concat_ws(" ", F.concat(F.lit("ZINC"), n), key)).otherwise(F.concat_ws("\t", key, F.concat(F.lit("zinc"), n)))
    return IO.two_columns(view(spark, d, "pages").select(line.alias("value")), "ZINC")


@query("nan_tokens", "SELECT validity_comment, count(*) AS n, count(*) FILTER (validity_comment IS NULL OR lower(trim(validity_comment)) IN ('', 'nan', 'none', 'null', 'na', '<na>', 'n/a')) AS n_missing FROM {fx_activity} GROUP BY validity_comment")
def _(spark, d):
    return view(spark, d, "fx_activity").groupBy("validity_comment").agg(F.count("*").alias("n"), F.count_if(S.is_missing(F.col("validity_comment"))).alias("n_missing"))


@query("key_normalise", r"SELECT doc_id, md5(nullif(lower(regexp_replace(trim(text), '\s+', ' ', 'g')), '')) AS key FROM documents")
def _(spark, d):
    return view(spark, d, "documents").select("doc_id", F.md5(S.key_text(F.col("text"))).alias("key"))


@query("unit_convert", "SELECT units, count(*) AS n, round(sum(value * CASE lower(trim(units)) WHEN 'nm' THEN 1.0 WHEN 'um' THEN 1000.0 WHEN 'mm' THEN 1000000.0 WHEN 'm' THEN 1000000000.0 END), 2) AS nm FROM {fx_activity} GROUP BY units")
def _(spark, d):
    return view(spark, d, "fx_activity").groupBy("units").agg(F.count("*").alias("n"), F.round(F.sum(F.col("value") * S.unit_factor(F.col("units"))), 2).alias("nm"))


@query("curate_filter", "SELECT target, structure, molecule_id, year, pos FROM {fx_curatable}")
def _(spark, d):
    return _curated(spark, d).select("target", "structure", "molecule_id", F.col("year").cast("bigint").alias("year"), "pos")


@query("label_derive", "SELECT pos, structure, round(label, 6) AS label FROM {fx_curatable}")
def _(spark, d):
    return _curated(spark, d).select("pos", "structure", F.round("label", 6).alias("label"))


@query("curate_median", """
SELECT target, structure, round(median(label), 6) AS label, count(*) AS n, arg_min(molecule_id, pos) AS molecule_id, min(year) AS year, max(year) AS year_max FROM {fx_curatable} GROUP BY target, structure""")
def _(spark, d):
    return rounded(_panel(spark, d), "label").select("target", "structure", "label", "n", "molecule_id", F.col("year").cast("bigint").alias("year"), F.col("year_max").cast("bigint").alias("year_max"))


@query("curate_output", f"WITH {PANEL} SELECT target, structure, round(label, 6) AS label, n, 'tables' AS source FROM panel")
def _(spark, d):
    out = C.finished(rounded(_panel(spark, d), "label"), {"source": "tables"})
    return out.select([c for c in out.columns if c not in ("molecule_id", "year", "year_max")])


@query("era_split", f"""
SELECT target, structure, round(median(label), 6) AS label, round(median(label) FILTER (year < {CUTOFF}), 6) AS label_pre, count(*) FILTER (year < {CUTOFF}) AS n_pre,
  round(median(label) FILTER (year >= {CUTOFF}), 6) AS label_post, count(*) FILTER (year >= {CUTOFF}) AS n_post FROM {{fx_curatable}} GROUP BY target, structure""")
def _(spark, d):
    return rounded(_panel(spark, d, CUTOFF), "label", "label_pre", "label_post").select("target", "structure", "label", "label_pre", "n_pre", "label_post", "n_post")


@query("per_target_counts", f"WITH {PANEL} SELECT target, count(*) AS entities, sum(n)::BIGINT AS measurements FROM panel GROUP BY target")
def _(spark, d):
    return C.counts_by_target(_panel(spark, d))


@query("selectivity_matrix", f"""
WITH {WIDE} SELECT structure, round(T0, 6) AS T0, round(T1, 6) AS T1, round(T2, 6) AS T2, round(T3, 6) AS T3, round(T0 - T1, 6) AS delta_T0_T1, round(T0 - T2, 6) AS delta_T0_T2, round(T0 - T3, 6) AS delta_T0_T3,
  round(least(T0 - T1, T0 - T2, T0 - T3), 6) AS delta_min FROM wide""")
def _(spark, d):
    wide = C.wide_panel(_panel(spark, d), PRIMARY, COMPARATORS)
    return rounded(wide, *[c for c in wide.columns if c != "structure"])


@query("default_primary", f"WITH {PANEL} SELECT target, count(*) AS entities FROM panel GROUP BY target ORDER BY entities DESC, target LIMIT 1")
def _(spark, d):
    return C.default_primary(_panel(spark, d))


@query("training_set", f"WITH {PANEL} SELECT structure, round(label, 6) AS label, n FROM panel WHERE target = 'T0'")
def _(spark, d):
    return rounded(C.training_set(_panel(spark, d), PRIMARY), "label")


@query("contract_violations", """
WITH t AS (SELECT CASE WHEN l_linenumber = 7 THEN NULL WHEN l_quantity = 50 THEN '  ' ELSE concat('P', l_partkey) END AS structure, CASE WHEN l_discount = 0.05 THEN NULL ELSE l_quantity / 4 END AS label FROM lineitem)
SELECT 'key_null' AS rule, count(*) FILTER (structure IS NULL) AS n FROM t UNION ALL SELECT 'label_null', count(*) FILTER (label IS NULL) FROM t UNION ALL SELECT 'label_low', count(*) FILTER (label < 3) FROM t
UNION ALL SELECT 'label_high', count(*) FILTER (label > 11) FROM t UNION ALL SELECT 'key_empty', count(*) FILTER (trim(structure) = '') FROM t""")
def _(spark, d):
    t = view(spark, d, "lineitem").select(F.when(F.col("l_linenumber") == 7, None).when(F.col("l_quantity") == 50, "  ").otherwise(F.concat(F.lit("P"), "l_partkey")).alias("structure"), F.when(F.col("l_discount") != 0.05, F.col("l_quantity") / 4).alias("label"))
    return C.violations(t)


@query("druglike_subset", "SELECT id FROM {fx_candidates} WHERE mw BETWEEN 150 AND 650 AND logp BETWEEN -2 AND 6 AND hbd <= 5 AND hba <= 10 AND tpsa <= 140 AND rotb <= 10 AND NOT alert")
def _(spark, d):
    c = view(spark, d, "fx_candidates")
    return c.where(C.druglike(c)).select("id")


@query("union_panel", f"WITH {PANEL} SELECT target, count(*) AS n, count(extra) AS n_extra FROM (SELECT target, NULL AS extra FROM panel WHERE target <> 'T0' UNION ALL SELECT target, 1 FROM panel WHERE target = 'T0') GROUP BY target")
def _(spark, d):
    p = _panel(spark, d)
    both = C.concat_targets([p.where("target <> 'T0'"), p.where("target = 'T0'").withColumn("extra", F.lit(1))])
    return both.groupBy("target").agg(F.count("*").alias("n"), F.count("extra").alias("n_extra"))


@query("paired_delta", f"WITH {WIDE} SELECT structure, 'T0-T1' AS pair, round(T0 - T1, 6) AS delta FROM wide WHERE T0 IS NOT NULL AND T1 IS NOT NULL UNION ALL SELECT structure, 'T0-T2', round(T0 - T2, 6) FROM wide WHERE T0 IS NOT NULL AND T2 IS NOT NULL UNION ALL SELECT structure, 'T0-T3', round(T0 - T3, 6) FROM wide WHERE T0 IS NOT NULL AND T3 IS NOT NULL")
def _(spark, d):
    return rounded(_pairs(spark, d).select("structure", "pair", "delta"), "delta")


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    long = A.paired_deltas(C.wide_panel(_panel(spark, d), PRIMARY, COMPARATORS), PRIMARY, COMPARATORS)
    return long.withColumn("id", F.substring("structure", 2, 20).cast("bigint")).withColumn("score", F.col("delta") * 0.7 + (S.hash_bucket(F.col("id"), 9) % 100) / 50.0)


PAIRS = WIDE + f""", pairs AS (SELECT *, CAST(substr(structure, 2) AS BIGINT) AS id, delta * 0.7 + ({bucket("CAST(substr(structure, 2) AS BIGINT)", 9)} % 100) / 50.0 AS score FROM (
  SELECT structure, 'T0-T1' AS pair, T0 - T1 AS delta FROM wide UNION ALL SELECT structure, 'T0-T2', T0 - T2 FROM wide UNION ALL SELECT structure, 'T0-T3', T0 - T3 FROM wide) AS u WHERE delta IS NOT NULL)"""

# cohorts --------------------------------------------------------------------------------------------------------------

_RULES = (("cell_based", r"licen[sc]e"), ("domain_1", r"\bthe\b"), ("domain_2", r"\bder\b|\bdie\b"), ("biochemical", r"\bla\b"))
_COHORT = H.Cohort("stand_in", ("domain_1", "domain_2"), ("cell_based", H.UNMATCHED, H.NO_DESCRIPTION), H.Structured(("en", "de"), ("B",), (("fr", "cell-based format"),), r"\bthe and\b|\bund die\b"))


def _selection(spark: SparkSession, d: str, cohort: H.Cohort = _COHORT) -> DataFrame:
    return H.select_assays(view(spark, d, "fx_assay"), cohort, _RULES)


#: DuckDB's word borders know ASCII letters only.
_border = lambda p: re.sub(r"\\b(\w+)\\b", r"(^|[^\\pL\\pN_])\1($|[^\\pL\\pN_])", p)
LABEL = r"CASE WHEN coalesce(lower(trim(description)), '') IN ('', 'nan') THEN 'no_description' " + " ".join(f"WHEN regexp_matches(description, '(?i){_border(p)}') THEN '{n}'" for n, p in _RULES) + " ELSE 'unmatched' END"
SELECTION = rf"""lab AS (SELECT *, {LABEL} AS label, regexp_extract(coalesce(description, ''), '(?i)(\bthe and\b|\bund die\b)', 1) AS tandem FROM {{fx_assay}}),
sel AS (SELECT *, CASE WHEN label IN ('cell_based', 'unmatched', 'no_description') THEN 'label ' || label || ' excluded' WHEN label NOT IN ('domain_1', 'domain_2') THEN 'label ' || label || ' not accepted'
  WHEN tandem <> '' THEN 'tandem-domain construct: ' || tandem WHEN coalesce(bao_format, '') = 'fr' THEN 'format fr is a cell-based format' WHEN coalesce(bao_format, '') = '' THEN 'format absent'
  WHEN bao_format NOT IN ('en', 'de') THEN 'format ' || bao_format || ' is ambiguous' WHEN coalesce(assay_type, '') = '' THEN 'type absent' WHEN assay_type <> 'B' THEN 'type ' || assay_type || ' conflicts' END AS reason FROM lab)"""


@query("classify_text", f"SELECT assay_id, {LABEL} AS label FROM {{fx_assay}}")
def _(spark, d):
    return view(spark, d, "fx_assay").select("assay_id", H.text_label(F.col("description"), _RULES).alias("label"))


@query("cohort_select", f"WITH {SELECTION} SELECT assay_id, label, reason, reason IS NULL AS admitted FROM sel")
def _(spark, d):
    return _selection(spark, d).select("assay_id", "label", "reason", "admitted")


@query("cohort_reasons", f"WITH {SELECTION} SELECT label, coalesce(reason, 'admitted') AS reason, count(*) AS n FROM sel GROUP BY 1, 2")
def _(spark, d):
    return H.reasons(_selection(spark, d))


@query("regex_capture", r"SELECT assay_id, regexp_extract(coalesce(description, ''), '(?i)(\bthe and\b|\bund die\b)', 1) AS found FROM {fx_assay}")
def _(spark, d):
    return view(spark, d, "fx_assay").select("assay_id", H.captured(F.col("description"), r"(\bthe and\b|\bund die\b)").alias("found"))


@query("cohort_apply", f"WITH {SELECTION} SELECT a.pos, a.structure, a.assay_id FROM {{fx_activity}} AS a WHERE a.assay_id IN (SELECT assay_id FROM sel WHERE reason IS NULL)")
def _(spark, d):
    return H.apply_to_activities(view(spark, d, "fx_activity"), _selection(spark, d)).select("pos", "structure", "assay_id")


@query("cohort_attrition", f"""
WITH {SELECTION}, f AS (SELECT a.structure, s.assay_id IS NOT NULL AS known, s.reason IS NULL AND s.assay_id IS NOT NULL AS ok FROM {{fx_activity}} AS a LEFT JOIN sel AS s ON a.assay_id = s.assay_id),
r AS (SELECT count(*) AS activities_in, count(*) FILTER (ok) AS activities_out, count(*) FILTER (NOT known) AS activities_unknown, count(DISTINCT structure) AS structures_in, count(DISTINCT structure) FILTER (ok) AS structures_out FROM f),
k AS (SELECT count(*) AS assays_in, count(*) FILTER (reason IS NULL) AS assays_out FROM sel)
SELECT *, CASE WHEN activities_in = 0 THEN 0 ELSE round(activities_out / activities_in, 4) END AS activity_share, CASE WHEN structures_in = 0 THEN 0 ELSE round(structures_out / structures_in, 4) END AS structure_share, CASE WHEN assays_in = 0 THEN 0 ELSE round(assays_out / assays_in, 4) END AS assay_share FROM k, r""")
def _(spark, d):
    return H.attrition(view(spark, d, "fx_activity"), _selection(spark, d))


COMPOSITION = SELECTION + """, ba AS (SELECT label, count(*) AS assays FROM sel GROUP BY label), br AS (SELECT coalesce(label, 'unknown') AS label, count(*) AS records FROM {fx_activity} AS a LEFT JOIN sel AS s ON a.assay_id = s.assay_id GROUP BY 1),
bc AS (SELECT coalesce(s.label, 'unknown') AS label, count(*) AS curated, median(c.label) AS median FROM {fx_curatable} AS c LEFT JOIN sel AS s ON c.assay_id = s.assay_id GROUP BY 1),
u AS (SELECT coalesce(ba.label, br.label) AS label, coalesce(assays, 0) AS assays, coalesce(records, 0) AS records FROM ba FULL JOIN br ON ba.label = br.label),
comp AS (SELECT u.label, assays, records, coalesce(curated, 0) AS curated, round(median, 6) AS median, round(100 * assays / sum(assays) OVER (), 4) AS assay_pct, round(100 * records / sum(records) OVER (), 4) AS record_pct FROM u LEFT JOIN bc ON u.label = bc.label)"""


def _composition(spark: SparkSession, d: str) -> DataFrame:
    return H.composition(_selection(spark, d), view(spark, d, "fx_activity"), _curated(spark, d).withColumn("value_label", F.col("label")).drop("label"))


@query("composition", f"WITH {COMPOSITION} SELECT * FROM comp")
def _(spark, d):
    return _composition(spark, d)


@query("composition_gaps", f"WITH {COMPOSITION} SELECT x.label AS a, y.label AS b, round(x.median - y.median, 6) AS gap FROM comp AS x JOIN comp AS y ON x.label < y.label WHERE x.median IS NOT NULL AND y.median IS NOT NULL")
def _(spark, d):
    return H.composition_gaps(_composition(spark, d))


_ENTITY = "P1"


@query("entity_across_labels", f"""
WITH {SELECTION} SELECT coalesce(s.label, 'unknown') AS label, round(median(c.label), 6) AS median, count(*) AS n FROM {{fx_curatable}} AS c LEFT JOIN sel AS s ON c.assay_id = s.assay_id WHERE structure = '{_ENTITY}' GROUP BY 1""")
def _(spark, d):
    return H.entity_across_labels(_selection(spark, d), _curated(spark, d).withColumn("value_label", F.col("label")).drop("label"), _ENTITY)


@query("cohort_subset", f"""
WITH {SELECTION}, old AS (SELECT assay_id FROM sel WHERE label IN ('domain_1', 'domain_2')), new AS (SELECT assay_id FROM sel WHERE reason IS NULL),
x AS (SELECT (SELECT count(*) FROM (FROM old EXCEPT ALL FROM new)) AS only_old, (SELECT count(*) FROM (FROM new EXCEPT ALL FROM old)) AS only_new) SELECT *, only_old = 0 AND only_new = 0 AS identical, only_new = 0 AS subset FROM x""")
def _(spark, d):
    loose = H.Cohort("loose", _COHORT.accept, _COHORT.exclude)
    return H.compare_selections(_selection(spark, d, loose), _selection(spark, d))


# splits, errors -------------------------------------------------------------------------------------------------------

REG = "count(*) AS n, round(CASE WHEN regr_syy(y, y) = 0 THEN CASE WHEN sum((y - p) * (y - p)) = 0 THEN 1 ELSE 0 END ELSE 1 - sum((y - p) * (y - p)) / regr_syy(y, y) END, 6) AS r2, round(avg(abs(y - p)), 6) AS mae, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse"


@query("random_split", f"SELECT p_partkey AS id, CASE WHEN {bucket('p_partkey')} % 100 < 20 THEN 'test' ELSE 'train' END AS split FROM part")
def _(spark, d):
    return P.random_split(view(spark, d, "part").select(F.col("p_partkey").alias("id")))


FOLDS = """s AS (SELECT grp, count(*) AS n FROM {fx_rows} GROUP BY grp), k AS (SELECT least(5, count(*)) AS k FROM s), r AS (SELECT grp, n, row_number() OVER (ORDER BY n DESC, grp) - 1 AS r FROM s),
f AS (SELECT grp, n, CASE WHEN (r // k) % 2 = 0 THEN r % k ELSE k - 1 - r % k END AS fold FROM r, k)"""


@query("group_kfold", f"WITH {FOLDS} SELECT fold::BIGINT AS fold, grp, n FROM f")
def _(spark, d):
    return P.group_folds(view(spark, d, "fx_rows")).groupBy("fold", "grp").agg(F.count("*").alias("n"))


@query("temporal_split", f"""
WITH t AS (SELECT median(label) FILTER (year < {CUTOFF}) AS label_pre, min(year) AS year FROM {{fx_curatable}} WHERE target = 'T0' GROUP BY structure),
c AS (SELECT count(*) FILTER (year < {CUTOFF} AND label_pre IS NOT NULL) AS n_train, count(*) FILTER (year < {CUTOFF} AND label_pre IS NULL) AS n_dropped, count(*) FILTER (year >= {CUTOFF}) AS n_test, count(*) FILTER (year IS NULL) AS n_undated FROM t)
SELECT *, n_train >= 50 AND n_test >= 20 AS evaluated FROM c""")
def _(spark, d):
    return P.temporal_counts(_panel(spark, d, CUTOFF).where("target = 'T0'"), CUTOFF)


@query("temporal_overlap", f"""
WITH t AS (SELECT grp, year >= {CUTOFF} AS is_test FROM {{fx_rows}} WHERE year IS NOT NULL), g AS (SELECT DISTINCT grp FROM t WHERE NOT is_test AND grp IS NOT NULL)
SELECT count(*) FILTER (NOT is_test) AS n_train, count(*) FILTER (is_test) AS n_test, count(DISTINCT t.grp) FILTER (NOT is_test) AS train_groups, round(avg((g.grp IS NOT NULL)::INT) FILTER (is_test), 6) AS overlap, round(100 * avg((g.grp IS NOT NULL)::INT) FILTER (is_test), 1) AS overlap_pct FROM t LEFT JOIN g ON t.grp = g.grp""")
def _(spark, d):
    return M.group_overlap(view(spark, d, "fx_rows").where("year IS NOT NULL").withColumn("is_test", F.col("year") >= CUTOFF))


@query("group_overlap", f"""
WITH t AS (SELECT concat(p_brand, p_size % 30) AS grp, {bucket('p_partkey')} % 100 < 60 AS is_test FROM part), g AS (SELECT DISTINCT grp FROM t WHERE NOT is_test)
SELECT count(*) FILTER (NOT is_test) AS n_train, count(*) FILTER (is_test) AS n_test, count(DISTINCT t.grp) FILTER (NOT is_test) AS train_groups, round(avg((g.grp IS NOT NULL)::INT) FILTER (is_test), 6) AS overlap, round(100 * avg((g.grp IS NOT NULL)::INT) FILTER (is_test), 1) AS overlap_pct FROM t LEFT JOIN g ON t.grp = g.grp""")
def _(spark, d):
    return M.group_overlap(view(spark, d, "part").select(F.concat("p_brand", F.col("p_size") % 30).alias("grp"), P.is_test("p_partkey", 60).alias("is_test")))


@query("y_scramble", f"""
WITH a AS (SELECT o_orderkey AS id, o_totalprice AS y, row_number() OVER (ORDER BY o_orderkey) AS r FROM orders), b AS (SELECT o_totalprice AS y, row_number() OVER (ORDER BY {bucket('o_orderkey', 11)}, o_orderkey) AS r FROM orders)
SELECT a.id, a.y, b.y AS y_scrambled FROM a JOIN b USING (r)""")
def _(spark, d):
    return P.scrambled(view(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("y"))).select("id", "y", "y_scrambled")


@query("inv_freq_weight", "SELECT p_partkey AS id, 1 / count(*) OVER (PARTITION BY p_brand) AS weight FROM part")
def _(spark, d):
    return P.group_weights(view(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("grp"))).select("id", "weight")


@query("one_per_group", "SELECT p_brand AS grp, min(p_partkey) AS id, arg_min(p_name, p_partkey) AS name FROM part GROUP BY p_brand")
def _(spark, d):
    return P.one_per_group(view(spark, d, "part").select(F.col("p_brand").alias("grp"), F.col("p_partkey").alias("id"), F.col("p_name").alias("name")))


@query("pair_eligibility", f"""
WITH {WIDE}, n AS (SELECT count(*) FILTER (T0 IS NOT NULL AND T1 IS NOT NULL) AS T1, count(*) FILTER (T0 IS NOT NULL AND T2 IS NOT NULL) AS T2, count(*) FILTER (T0 IS NOT NULL AND T3 IS NOT NULL) AS T3, count(DISTINCT structure) AS g FROM wide),
l AS (SELECT 'T1' AS comparator, T1 AS n, g FROM n UNION ALL SELECT 'T2', T2, g FROM n UNION ALL SELECT 'T3', T3, g FROM n)
SELECT comparator, n, CASE WHEN g < 2 THEN 'too few groups' WHEN n < 25 THEN 'too few rows' END AS reason FROM l UNION ALL SELECT 'T9', 0, 'target absent'""")
def _(spark, d):
    return P.pair_eligibility(C.wide_panel(_panel(spark, d), PRIMARY, COMPARATORS), PRIMARY, [*COMPARATORS, "T9"], "structure")


@query("oof_mean", f"WITH {FOLDS}, q AS (SELECT r.id, r.y, r.grp, f.fold FROM {{fx_rows}} AS r JOIN f ON r.grp = f.grp), b AS (SELECT fold, sum(y) AS s, count(y) AS n FROM q GROUP BY fold), t AS (SELECT sum(s) AS s, sum(n) AS n FROM b) SELECT fold::BIGINT AS fold, count(*) AS rows, round(max((t.s - b.s) / (t.n - b.n)), 4) AS p FROM q JOIN b USING (fold), t GROUP BY fold")
def _(spark, d):
    return P.oof_mean(P.group_folds(view(spark, d, "fx_rows"))).groupBy("fold").agg(F.count("*").alias("rows"), F.round(F.max("p"), 4).alias("p"))


@query("reg_metrics", f"SELECT {REG} FROM {{fx_pred}}")
def _(spark, d):
    return M.regression(view(spark, d, "fx_pred"))


@query("fold_metrics", f"WITH m AS (SELECT fold, {REG} FROM {{fx_pred}} GROUP BY fold) SELECT count(*) AS folds, round(avg(r2), 6) AS r2_mean, round(stddev_pop(r2), 6) AS r2_std FROM (SELECT fold, 1 - sum((y - p) * (y - p)) / regr_syy(y, y) AS r2 FROM {{fx_pred}} GROUP BY fold)")
def _(spark, d):
    return M.fold_summary(view(spark, d, "fx_pred"))


@query("mean_baseline", f"WITH t AS (SELECT *, {bucket('id')} % 100 < 20 AS test FROM {{fx_rows}}), m AS (SELECT avg(y) AS p FROM t WHERE NOT test) SELECT {REG} FROM t, m WHERE test")
def _(spark, d):
    return M.mean_baseline(view(spark, d, "fx_rows").select("id", "y"), P.is_test("id"))


@query("ridge_1d", "SELECT count(*) AS n, round(regr_sxy(y, x) / (regr_sxx(y, x) + 1), 6) AS slope, round(avg(y) - regr_sxy(y, x) / (regr_sxx(y, x) + 1) * avg(x), 4) AS intercept FROM {fx_rows}")
def _(spark, d):
    return M.ridge_one_feature(view(spark, d, "fx_rows"))


@query("conformal_band", f"""
WITH e AS (SELECT abs(y - p) AS e, {bucket('id', 2)} % 100 < 25 AS cal FROM {{fx_pred}}), c AS (SELECT e, row_number() OVER (ORDER BY e) - 1 AS r, count(*) OVER () AS n FROM e WHERE cal),
h AS (SELECT n, e FROM c WHERE r = ceil(least(1.0, ceil((n + 1) * 0.9) / n) * (n - 1)))
SELECT h.n AS n_cal, round(h.e, 6) AS halfwidth, count(*) AS n_test, round(avg((e.e <= h.e)::INT), 6) AS covered FROM e, h WHERE NOT cal GROUP BY h.n, h.e""")
def _(spark, d):
    return M.conformal_band(view(spark, d, "fx_pred"), S.hash_bucket(F.col("id"), 2) % 100 < 25)


@query("gates", f"""
WITH m AS (SELECT {REG} FROM {{fx_pred}}), l AS (SELECT 'r2' AS metric, r2 AS value FROM m UNION ALL SELECT 'mae', mae FROM m UNION ALL SELECT 'rmse', rmse FROM m),
g AS (SELECT * FROM (VALUES ('r2', '>=', 0.55), ('mae', '<=', 1e4), ('overlap', '<=', 0.5)) AS t(gate, op, threshold)),
j AS (SELECT gate, value, threshold::DOUBLE AS threshold, coalesce(CASE WHEN op = '>=' THEN value >= threshold ELSE value <= threshold END, false) AS passed FROM g LEFT JOIN l ON gate = metric)
SELECT *, bool_and(passed) OVER () AS all_passed FROM j""")
def _(spark, d):
    one = M.regression(view(spark, d, "fx_pred"))
    return M.gates(one.unpivot([], ["r2", "mae", "rmse"], "metric", "value"), {"r2": (">=", 0.55), "mae": ("<=", 1e4), "overlap": ("<=", 0.5)})


# similarity -----------------------------------------------------------------------------------------------------------

SIM = """x AS (SELECT vec_id AS q, len(bits) AS qn, fold AS qf, train AS qt, unnest(bits) AS bit FROM {fx_bits}),
pairs AS (SELECT x.q, y.q AS r, any_value(x.qf) AS qf, any_value(y.qf) AS rf, any_value(x.qt) AS qt, any_value(y.qt) AS rt, round(count(*) / (any_value(x.qn) + any_value(y.qn) - count(*)), 9) AS s FROM x JOIN x AS y USING (bit) GROUP BY x.q, y.q)"""


def _bits(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "fx_bits")


@query("fp_bits", "SELECT vec_id, len(bits)::BIGINT AS n, list_sum(bits)::BIGINT AS total, array_to_string(bits, ',') AS bits FROM {fx_bits}")
def _(spark, d):
    made = view(spark, d, "embeddings").select("vec_id", N.threshold_bits("embedding", 0.1).alias("b"))
    return made.select("vec_id", F.size("b").cast("bigint").alias("n"), F.aggregate("b", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"), F.array_join("b", ",").alias("bits"))


@query("pair_tanimoto", f"WITH {SIM} SELECT q, r, s AS similarity FROM pairs WHERE NOT qt AND rt")
def _(spark, d):
    b = _bits(spark, d)
    return N.pair_similarities(b.where("NOT train"), b.where("train"), "vec_id", "vec_id")


NEAREST = SIM + ", best AS (SELECT q, max(s) AS nn, min(r) FILTER (s = m) AS nearest FROM (SELECT *, max(s) OVER (PARTITION BY q) AS m FROM pairs WHERE NOT qt AND rt) GROUP BY q), nn AS (SELECT b.vec_id AS q, b.grp, coalesce(best.nn, 0) AS nn, best.nearest FROM {fx_bits} AS b LEFT JOIN best ON b.vec_id = best.q WHERE NOT b.train)"


def _nearest(spark: SparkSession, d: str) -> DataFrame:
    b = _bits(spark, d)
    return N.nearest(b.where("NOT train"), b.where("train"), "vec_id", "vec_id")


@query("nn_tanimoto", f"WITH {NEAREST} SELECT q, nn, nearest FROM nn")
def _(spark, d):
    return _nearest(spark, d)


@query("oof_nn", f"WITH {SIM} SELECT b.vec_id AS q, coalesce(max(s), 0) AS nn FROM {{fx_bits}} AS b LEFT JOIN pairs ON b.vec_id = q AND qf <> rf GROUP BY b.vec_id")
def _(spark, d):
    b = _bits(spark, d)
    return N.nearest(b, b, "vec_id", "vec_id", "fold").select("q", "nn")


@query("text_bits")
def _(spark, d):
    """Bits of documents' texts: hashes of three characters each (no SQL: the hash is Spark's)."""
    return view(spark, d, "documents").select("doc_id", F.size(N.text_bits(F.col("text"))).alias("n"))


@query("sim_threshold", f"WITH {SIM} SELECT q, r, s AS similarity FROM pairs WHERE NOT qt AND rt AND s >= 0.4")
def _(spark, d):
    b = _bits(spark, d)
    return N.threshold_matches(b.where("NOT train"), b.where("train"), "vec_id", "vec_id", 0.4)


@query("top_matches", f"WITH {SIM} SELECT q, row_number() OVER (PARTITION BY q ORDER BY s DESC, r) AS rank, r, s AS similarity FROM pairs WHERE NOT qt AND rt QUALIFY rank <= 5")
def _(spark, d):
    """The five most similar references of each query: what is listed of the pairs at scale."""
    b = _bits(spark, d)
    return N.most_similar(b.where("NOT train"), b.where("train"), "vec_id", "vec_id", 5)


def _reference_sets(b: DataFrame) -> DataFrame:
    return b.where("train").withColumn("set_name", F.explode(F.array_compact(F.array(F.lit("train"), F.when(F.col("grp") < 4, "actives"), F.when(F.col("vec_id") % 10 == 0, "known")))))


@query("three_similarities", f"""
WITH {SIM}, e AS (SELECT p.*, g.grp FROM pairs AS p JOIN {{fx_bits}} AS g ON p.r = g.vec_id WHERE NOT qt AND rt), k AS (SELECT q, max(s) AS m FROM e WHERE r % 10 = 0 GROUP BY q),
c AS (SELECT e.q, min(r) AS closest FROM e JOIN k ON e.q = k.q AND e.s = k.m WHERE r % 10 = 0 GROUP BY e.q), a AS (SELECT q, max(s) AS t, max(s) FILTER (grp < 4) AS a FROM e GROUP BY q)
SELECT b.vec_id AS q, coalesce(a.t, 0) AS sim_train, coalesce(a.a, 0) AS sim_actives, coalesce(k.m, 0) AS sim_known, c.closest FROM {{fx_bits}} AS b LEFT JOIN a ON b.vec_id = a.q LEFT JOIN k ON b.vec_id = k.q LEFT JOIN c ON b.vec_id = c.q WHERE NOT b.train""")
def _(spark, d):
    b = _bits(spark, d)
    return N.three_similarities(b.where("NOT train"), _reference_sets(b), "vec_id", "vec_id")


def _nn_rows(spark: SparkSession, d: str) -> DataFrame:
    """Nearest similarities as rows with a truth and a prediction that gets worse with distance."""
    return _nearest(spark, d).select("q", "nn", (F.col("q") % 50 / 10.0).alias("y"), (F.col("q") % 50 / 10.0 + (1 - F.col("nn")) * (F.col("q") % 7 - 3)).alias("p"))


NN_ROWS = NEAREST + ", t AS (SELECT q, nn, q % 50 / 10.0 AS y, q % 50 / 10.0 + (1 - nn) * (q % 7 - 3) AS p FROM nn)"
_bin_sql = lambda bins: ", ".join(f"({i}, {lo}, {hi})" for i, (lo, hi) in enumerate(bins))


@query("ad_curve", f"WITH {NN_ROWS}, b AS (SELECT bin, lo::DOUBLE AS lo, hi::DOUBLE AS hi FROM (VALUES {_bin_sql(M.AD_BINS)}) AS v(bin, lo, hi)) SELECT bin, any_value(lo) AS lo, any_value(hi) AS hi, count(t.q) AS n, round(avg(abs(y - p)), 6) AS mae FROM b LEFT JOIN t ON nn >= lo AND nn < hi GROUP BY bin")
def _(spark, d):
    return M.ad_curve(_nn_rows(spark, d))


@query("ad_reliability", f"""
WITH {NN_ROWS}, b AS (SELECT bin, lo::DOUBLE AS lo, hi::DOUBLE AS hi FROM (VALUES {_bin_sql(M.FINE_BINS)}) AS v(bin, lo, hi)), c AS (SELECT count(*) AS total FROM t)
SELECT bin, any_value(lo) AS lo, count(t.q) AS n, round(100 * count(t.q) / any_value(total), 4) AS pct, round(avg(abs(y - p)), 6) AS mae, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse, round(avg((abs(y - p) <= 0.955)::INT), 6) AS coverage, round(median(abs(y - p)), 6) AS median_residual
FROM b LEFT JOIN t ON nn >= lo AND nn < hi, c GROUP BY bin""")
def _(spark, d):
    return M.ad_reliability(_nn_rows(spark, d), 0.955)


@query("ad_correlation", f"WITH {NN_ROWS} SELECT round(corr(nn, abs(y - p)), 6) AS correlation, count(*) AS n FROM t")
def _(spark, d):
    return M.similarity_error_correlation(_nn_rows(spark, d))


@query("ad_cumulative", f"WITH {NN_ROWS}, h AS (SELECT threshold::DOUBLE AS threshold FROM (VALUES {', '.join(f'({x})' for x in M.THRESHOLDS)}) AS v(threshold)) SELECT threshold, count(*) FILTER (nn >= threshold) AS n_above, count(*) FILTER (nn < threshold) AS n_below, round(avg(abs(y - p)) FILTER (nn >= threshold), 6) AS mae_above, round(avg(abs(y - p)) FILTER (nn < threshold), 6) AS mae_below FROM t, h GROUP BY threshold")
def _(spark, d):
    return M.ad_cumulative(_nn_rows(spark, d))


@query("leakage_report", f"""
WITH {NEAREST}, g AS (SELECT DISTINCT grp FROM {{fx_bits}} WHERE train) SELECT round(quantile_cont(nn, 0.5), 6) AS nn_median, round(quantile_cont(nn, 0.95), 6) AS nn_p95, count(*) FILTER (nn >= 0.999) AS near_identical, round(avg((grp IN (SELECT grp FROM g))::INT), 6) AS overlap FROM nn""")
def _(spark, d):
    overlap = M.group_overlap(_bits(spark, d).withColumn("is_test", ~F.col("train")))
    return M.leakage(_nearest(spark, d), overlap)
