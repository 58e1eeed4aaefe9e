"""Views over the star-schema tables that have the shapes of measurement panels.

One SQL text per view and engine; `{name}` stands for a table or another view. Texts that both engines read are given once.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: Bucket of an id, the same in both engines and on any partitioning. 0 <= bucket < 4294967296.
HASH = "((({0} % 1000003) * 2654435761 + {1} * 40503) % 4294967296)"
CUTOFF = 1999


def bucket(column: str, seed: int = 0) -> str:
    return HASH.format(column, seed)


_ACTIVITY = """
SELECT concat('P', l_partkey) AS structure, concat('M', l_orderkey) AS molecule_id, concat('T', l_orderkey % 4) AS target, l_suppkey AS assay_id,
  CASE WHEN l_discount = 0.10 THEN 'Ki' ELSE 'IC50' END AS type, l_extendedprice AS value,
  CASE WHEN l_returnflag = 'A' THEN 'nM' WHEN l_returnflag = 'R' THEN ' uM' WHEN l_quantity >= 25 THEN 'NM' ELSE 'weird' END AS units,
  CASE WHEN l_linestatus = 'O' THEN '=' WHEN l_linenumber = 1 THEN NULL ELSE '>' END AS relation,
  CASE WHEN l_tax = 0.0 THEN l_quantity / 5 END AS direct_value,
  CASE WHEN l_tax = 0.08 THEN 'Outside typical range' WHEN l_tax = 0.07 THEN ' NaN ' END AS validity_comment,
  CASE WHEN l_discount = 0.09 THEN 'Not Active' WHEN l_discount = 0.08 THEN 'tested' END AS activity_comment,
  CASE WHEN l_quantity > 3 THEN year(l_shipdate) END AS year, l_orderkey * 10 + l_linenumber AS pos
FROM {lineitem}"""

_CURATABLE = """
SELECT target, structure, molecule_id, year, pos, assay_id, CASE WHEN direct_value IS NOT NULL THEN direct_value WHEN nm > 0 THEN 9 - log10(nm) END AS label FROM (
  SELECT *, value * CASE lower(trim(units)) WHEN 'nm' THEN 1.0 WHEN 'um' THEN 1000.0 WHEN 'mm' THEN 1000000.0 WHEN 'm' THEN 1000000000.0 END AS nm FROM {fx_activity}
  WHERE (validity_comment IS NULL OR lower(trim(validity_comment)) IN ('', 'nan', 'none', 'null', 'na', '<na>', 'n/a'))
  AND NOT coalesce(lower(trim(activity_comment)) IN ('inactive', 'not active'), false)) AS f
WHERE type = 'IC50' AND (direct_value IS NOT NULL OR (nm IS NOT NULL AND (relation IS NULL OR relation = '=')))
  AND (CASE WHEN direct_value IS NOT NULL THEN direct_value WHEN nm > 0 THEN 9 - log10(nm) END) BETWEEN 3 AND 11"""

#: name -> text for both engines, or (Spark, DuckDB).
VIEWS: dict[str, str | tuple[str, str]] = {
    "fx_activity": _ACTIVITY,
    "fx_curatable": _CURATABLE,
    "fx_assay": """
SELECT d.doc_id AS assay_id, CASE WHEN d.doc_id % 23 = 0 THEN NULL WHEN d.doc_id % 29 = 0 THEN 'nan' ELSE d.text END AS description, CASE WHEN d.lang = 'es' THEN NULL ELSE d.lang END AS bao_format,
  CASE WHEN l.quality IS NULL THEN NULL WHEN l.quality = 1 THEN 'B' ELSE 'F' END AS assay_type
FROM {documents} AS d LEFT JOIN {labels} AS l ON d.doc_id = l.doc_id""",
    "fx_bits": (
        f"SELECT vec_id, label AS grp, filter(sequence(0, 63), i -> CAST(embedding[i] AS DOUBLE) > 0.1) AS bits, {bucket('vec_id')} % 5 AS fold, {bucket('vec_id', 1)} % 100 >= 20 AS train FROM {{embeddings}}",
        f"SELECT vec_id, label AS grp, list_filter(range(0, 64), lambda i: CAST(embedding[i + 1] AS DOUBLE) > 0.1) AS bits, {bucket('vec_id')} % 5 AS fold, {bucket('vec_id', 1)} % 100 >= 20 AS train FROM {{embeddings}}",
    ),
    "fx_rows": "SELECT l_orderkey * 10 + l_linenumber AS id, p_brand AS grp, l_extendedprice AS y, year(l_shipdate) AS year, l_quantity AS x FROM {lineitem} JOIN {part} ON l_partkey = p_partkey",
    "fx_pred": f"""
SELECT id, grp, fold, y, p FROM (SELECT r.id, r.grp, r.y, r.year, r.x, {bucket('id')} % 5 AS fold, 1000 + 1400 * x + 37 * ({bucket('id', 3)} % 100) AS p FROM {{fx_rows}} AS r) AS q""",
    "fx_library": f"""
SELECT doc_id, CASE WHEN length(trim(text)) < 40 THEN NULL ELSE lower(regexp_replace(trim(text), '\\\\s+', ' ', 'g')) END AS key, n_chars AS size, doc_id AS pos, {bucket('doc_id')} AS h FROM {{documents}}""",
    "fx_candidates": f"""
SELECT p_partkey AS id, p_name AS name, p_brand AS grp, CAST(4 + ((p_retailprice * 7) % 400) / 80 AS DOUBLE) AS prediction, CAST(CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE (p_size - 25) / 10.0 END AS DOUBLE) AS delta,
  CAST(200 + p_size * 8.0 AS DOUBLE) AS mw, CAST((p_size % 9) - 2.0 AS DOUBLE) AS logp, p_size % 7 AS hbd, p_size % 13 AS hba, CAST(p_size * 3.0 AS DOUBLE) AS tpsa, p_size % 12 AS rotb, p_type LIKE 'PROMO%' AS alert,
  CAST(({bucket('p_partkey', 5)} % 1001) / 1000.0 AS DOUBLE) AS sim, concat('C', p_partkey % 40) AS closest FROM {{part}}""",
    "fx_points": (
        "SELECT vec_id, concat('E', label) AS entry, vec_id % 6 AS grp, CAST(embedding[0] AS DOUBLE) * 40 AS x, CAST(embedding[1] AS DOUBLE) * 40 AS y, CAST(embedding[2] AS DOUBLE) * 40 AS z FROM {embeddings}",
        "SELECT vec_id, concat('E', label) AS entry, vec_id % 6 AS grp, CAST(embedding[1] AS DOUBLE) * 40 AS x, CAST(embedding[2] AS DOUBLE) * 40 AS y, CAST(embedding[3] AS DOUBLE) * 40 AS z FROM {embeddings}",
    ),
    "fx_metrics_a": """
SELECT concat(o_orderstatus, '.', o_orderpriority) AS path, CAST(round(avg(o_totalprice), 4) AS DOUBLE) AS value FROM {orders} GROUP BY o_orderstatus, o_orderpriority""",
    "fx_metrics_b": """
SELECT CASE WHEN path LIKE 'F.1%' THEN concat(path, '.new') ELSE path END AS path,
  CASE WHEN path LIKE 'O.2%' THEN value * 1.5 WHEN path LIKE 'O.3%' THEN value + 1e-13 * value WHEN path LIKE 'P.4%' THEN NULL ELSE value END AS value FROM {fx_metrics_a} WHERE path NOT LIKE 'P.5%'""",
}
# Spark's regexp_replace always replaces all matches and has no flags argument
_library = VIEWS["fx_library"]
VIEWS["fx_library"] = (_library.replace(", 'g')", ")"), _library.replace("\\\\s", "\\s"))

_NAMES = re.compile(r"\{(\w+)\}")


def _text(name: str, engine: int) -> str:
    text = VIEWS[name]
    return text if isinstance(text, str) else text[engine]


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table or view as a DataFrame."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = _text(name, 0)
    return spark.sql(text, **{n: view(spark, sf_dir, n) for n in set(_NAMES.findall(text))})


def oracle(body: str) -> str:
    """DuckDB SQL of body, with the views that it names as `{view}` as common table expressions."""
    ctes: dict[str, str] = {}

    def add(text: str) -> str:
        for n in _NAMES.findall(text):
            if n in VIEWS and n not in ctes:
                made = add(_text(n, 1))
                ctes[n] = made
        return _NAMES.sub(r"\1", text)

    body = add(body).strip()
    if not ctes:
        return body
    named = ",\n".join(f"{n} AS ({t.strip()})" for n, t in ctes.items())
    rest = re.sub(r"^WITH\s+", "", body, flags=re.I)
    return f"WITH {named}{',' if rest != body else ''}\n{rest}"
