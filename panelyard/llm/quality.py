"""Quality rules: a threshold table compiled into one Spark projection, no user functions.

Words are runs of characters other than U+0020 and U+0009-U+000D; lines are split at "\\n".
Null and empty texts have no words, so every count is 0 and the document fails. Repeated rows
give equal rows. Extra columns are kept out of the counts and never clash: only the id and text
columns are read, and measure columns are added under free names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from .common import table

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
# Frequent function words of the corpus languages.
STOP_WORDS = (
    "the and of to in is that it for with as was by on be this from are at or an a "
    "de la le les et des en un une du que est pour dans qui sur par pas au avec "
    "der die und den von zu das mit sich des auf ist im dem nicht ein eine "
    "el los las del se por con para una su al lo como más o pero sus y e i il"
).split()
#: As written inside and at the start of a sentence.
STOPS = list(dict.fromkeys([*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)]))


@dataclass(frozen=True)
class Rule:
    """One row of the threshold table: the document passes while low <= measure <= high."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: Measures are SQL expressions over the counts of `counts`; ratios of nothing are 0.
RULES = (
    Rule("mean_word_length", "word_chars / greatest(n_words, 1)", 2.0, 20.0),
    Rule("symbol_ratio", "n_symbols / greatest(n_words, 1)", None, 0.3),
    Rule("stop_word_ratio", "n_stop / greatest(n_words, 1)", 0.02, None),
    Rule("duplicate_line_ratio", "n_dup_lines / greatest(n_lines, 1)", None, 0.4),
    Rule("capital_ratio", "n_capitals / greatest(word_chars, 1)", None, 0.4),
    Rule("exclamation_ratio", "n_marks / greatest(n_words, 1)", None, 0.4),
)


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


#: Low bits of a long that hold a position (a text has at most 2^30 words); the others hold the beginning of the window's hash.
POSITION_BITS = 30


def _repeats(words: str = "_w", n: str = "_n", bits: int = POSITION_BITS) -> tuple[str, str, str]:
    """SQL of (windows as longs in order, neighbours with equal hashes, positions of the windows that are found twice or more).

    Equal windows have equal hashes, so they stand in one run of a plain sort, and neighbours of a run are compared word by
    word. If two of them differ, different windows share a hash, and one may stand between equal ones: then the windows
    themselves are sorted instead. (A single space joins their words, which hold none.)
    """
    mask = (1 << bits) - 1
    last = f"{n} - 3"
    packed = (
        f"CASE WHEN {n} < 4 THEN array() ELSE sort_array(transform(sequence(0, {last}), i -> "
        f"(xxhash64({words}[i], {words}[i + 1], {words}[i + 2]) & {~mask}L) | i)) END"
    )
    runs = f"CASE WHEN size(_p) < 2 THEN array() ELSE filter(sequence(1, size(_p) - 1), j -> shiftright(_p[j], {bits}) = shiftright(_p[j - 1], {bits})) END"
    same = " AND ".join(f"{words}[int(_p[j] & {mask}L) + {k}] = {words}[int(_p[j - 1] & {mask}L) + {k}]" for k in range(3))
    gram = f"concat_ws(' ', {words}[i], {words}[i + 1], {words}[i + 2])"
    slow = (
        "transform(filter(flatten(transform(array(sort_array(transform("
        f"sequence(0, {last}), i -> struct({gram} AS g, i AS i)))), s -> transform(sequence(0, size(s) - 1), j -> "
        "struct(s[j].i AS i, (j > 0 AND s[j - 1].g = s[j].g) OR (j < size(s) - 1 AND s[j + 1].g = s[j].g) AS hit)))), x -> x.hit), x -> bigint(x.i))"
    )
    found = (
        f"CASE WHEN size(_j) = 0 THEN array() WHEN exists(_j, j -> NOT ({same})) THEN sort_array({slow}) "
        f"ELSE sort_array(array_distinct(flatten(transform(_j, j -> array(_p[j] & {mask}L, _p[j - 1] & {mask}L))))) END"
    )
    return packed, runs, found


def counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = POSITION_BITS) -> DataFrame:
    """Per row of docs: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and the counts that RULES use."""
    packed, runs, found = _repeats(bits=bits)
    t = F.coalesce(F.col(text), F.lit(""))
    bare = _without(F.col("_t"), SPACES)
    one = docs.select(F.col(doc_id).alias("doc_id"), t.alias("_t"))
    two = one.select(
        "doc_id", "_t", bare.alias("_bare"),
        F.when(F.trim(F.col("_t"), F.lit(SPACES)) == "", F.array().cast("array<string>")).otherwise(F.split(F.trim(F.col("_t"), F.lit(SPACES)), "[ \\x09-\\x0D]+")).alias("_w"),
        F.filter(F.split("_t", "\n"), lambda x: F.trim(x, F.lit(SPACES)) != "").alias("_l"),
    )
    three = two.select(
        "doc_id", "_w", "_l", F.size("_w").alias("_n"), F.length("_bare").alias("_c"),
        (F.length("_bare") - F.length(_without(F.col("_bare"), SYMBOLS))).alias("_s"),
        (F.length("_bare") - F.length(_without(F.col("_bare"), "ABCDEFGHIJKLMNOPQRSTUVWXYZÄÖÜÉÈÀÇÑÊÓÍ"))).alias("_caps"),
        (F.length("_bare") - F.length(_without(F.col("_bare"), "!"))).alias("_marks"),
    )
    stops = F.size(F.filter("_w", lambda w: w.isin(STOPS)))
    kept = ("doc_id", "_l", "_n", "_c", "_s", "_caps", "_marks")
    four = three.select(*kept, "_w", stops.alias("_stop"), F.expr(packed).cast("array<bigint>").alias("_p"))
    five = four.select(*kept, "_w", "_stop", "_p", F.expr(runs).cast("array<int>").alias("_j"))
    five = five.select(*kept, "_stop", F.expr(found).cast("array<bigint>").alias("_r"))
    covered = F.expr("aggregate(_r, struct(-3L AS last, 0L AS sum), (a, x) -> struct(x AS last, a.sum + least(3L, x - a.last) AS sum), a -> a.sum)")
    as_long = {"n_words": F.col("_n"), "word_chars": F.col("_c"), "n_symbols": F.col("_s"), "n_dup_lines": F.size("_l") - F.size(F.array_distinct("_l")),
               "n_repeat_words": covered, "n_lines": F.size("_l"), "n_stop": F.col("_stop"), "n_capitals": F.col("_caps"), "n_marks": F.col("_marks")}
    return five.select("doc_id", *(c.cast("long").alias(k) for k, c in as_long.items()))


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """The threshold table as one boolean Column."""
    ok = F.lit(True)
    for r in rules:
        m = F.expr(r.measure)
        ok = ok & (m >= r.low if r.low is not None else F.lit(True)) & (m <= r.high if r.high is not None else F.lit(True))
    return ok


def failed_rules(rules: tuple[Rule, ...] = RULES) -> Column:
    """Names of the rules that the row breaks, comma-joined."""
    return F.concat_ws(",", *(F.when(~verdict((r,)), F.lit(r.name)) for r in rules))


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts, base_failed (under 50 words, or over half of the words in repeated 3-word windows), kept and failed rule names."""
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counts(docs, doc_id, text).select("*", base.alias("base_failed"), (~base & verdict(rules)).alias("kept"), failed_rules(rules).alias("failed"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs that pass, with the columns of docs; the projection runs on the same row, no join."""
    names = docs.columns
    packed = docs.select(F.struct(*[docs[c] for c in names]).alias("row"), docs["text"].alias("text"))
    # an array of one row or none: a filter would be pushed below the counts, and be computed anew for each use of a word
    kept = quality_rules(packed, doc_id="row").select(F.explode(F.when(F.col("kept"), F.array("doc_id")).otherwise(F.array().cast(ArrayType(packed.schema["row"].dataType)))).alias("row"))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in names])


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLE = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM w, unnest(range(1, len(w) - 1)) AS u(i)),
h AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
c AS (SELECT r, count(DISTINCT i + k) AS n FROM h, unnest([0, 1, 2]) AS u(k) GROUP BY r),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
  (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
  coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(l)::BIGINT AS n_lines,
  len(list_filter(w, lambda x: list_contains([{', '.join(f"'{x}'" for x in STOPS)}], x)))::BIGINT AS n_stop,
  (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZÄÖÜÉÈÀÇÑÊÓÍ', '')))::BIGINT AS n_capitals,
  (length(t) - length(replace(t, '!', '')))::BIGINT AS n_marks
  FROM w LEFT JOIN c USING (r)),
b AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  {', '.join(f"NOT ({' AND '.join([f'{r.measure} >= {r.low}'] * (r.low is not None) + [f'{r.measure} <= {r.high}'] * (r.high is not None))}) AS f{k}" for k, r in enumerate(RULES))} FROM m)
SELECT * EXCLUDE ({', '.join(f'f{k}' for k in range(len(RULES)))}), NOT base_failed AND {' AND '.join(f'NOT f{k}' for k in range(len(RULES)))} AS kept,
  concat_ws(',', {', '.join(f"CASE WHEN f{k} THEN '{r.name}' END" for k, r in enumerate(RULES))}) AS failed FROM b
"""
