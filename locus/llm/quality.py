"""Quality rules: a threshold table compiled into one projection of native expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, table, words

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that for it as was with by on are this at from or an be not have "
    "der die das und ist nicht ein eine zu den mit von im sich auf für dem des es als auch "
    "le la les de des et un une du en est que qui dans pour pas sur au il ne ce "
    "el los las y del que en por con para se no al lo su como más o a"
).split()


@dataclass(frozen=True)
class Threshold:
    """A text passes if low <= metric <= high; None leaves a side open."""

    metric: str
    low: float | None = None
    high: float | None = None


#: The production table. Wide bounds: they reject junk and leave prose alone.
THRESHOLDS = (
    Threshold("mean_word_chars", 2.0, 18.0),
    Threshold("symbol_ratio", high=0.10),
    Threshold("stop_word_ratio", low=0.02),
    Threshold("alphabetic_ratio", low=0.50),
    Threshold("duplicate_line_ratio", high=0.50),
    Threshold("bullet_line_ratio", high=0.90),
    Threshold("ellipsis_line_ratio", high=0.50),
)


def repeated_words(ws: Column) -> Column:
    """How many words lie in 3-word windows that the text holds twice or more.

    Windows are sorted with their places; a window equal to a neighbour is repeated, and each repeated place
    adds the words that the one before it has not covered. n log n in the text's own length.
    """

    def covered(ordered: Column) -> Column:
        last = F.size(ordered) - 1
        hit = F.filter(ordered, lambda x, i: ((i > 0) & (F.get(ordered, i - 1)["w"] == x["w"])) | ((i < last) & (F.get(ordered, i + 1)["w"] == x["w"])))
        places = F.array_sort(F.transform(hit, lambda x: x["i"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(places, start, lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"), p.alias("last")), lambda acc: acc["n"])

    windows = F.transform(F.sequence(F.lit(0), F.size(ws) - 3), lambda i: F.struct(F.concat_ws(" ", F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)).alias("w"), i.alias("i")))
    return F.when(F.size(ws) < 3, F.lit(0)).otherwise(let(F.array_sort(windows), covered)).cast("long")


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def compiled(thresholds: Sequence[Threshold]) -> Column:
    """One boolean expression for the whole table."""
    passes = F.lit(True)
    for t in thresholds:
        if t.low is not None:
            passes = passes & (F.col(t.metric) >= t.low)
        if t.high is not None:
            passes = passes & (F.col(t.metric) <= t.high)
    return passes


def measured(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), thresholds: Sequence[Threshold] = THRESHOLDS, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """The kept columns with the counts, ratios and verdict of every row's whole text.

    A null or blank text has zero counts and ratios and fails the base rule (fewer than 50 words). Repeated rows
    are judged each on its own; other columns are not read, so their names cannot clash. A very long text is judged whole
    by one task, in n log n of its words; an empty table gives an empty result.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    arrays = docs.select(*[F.col(c) for c in keep], body.alias("_t"), words(F.col(text)).alias("_w"), F.filter(F.split(body, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_l"))
    stop = list(dict.fromkeys(stop_words))  # a literal list becomes a hash set
    n_words, n_lines = F.size("_w").cast("long"), F.size("_l").cast("long")
    counts = arrays.select(
        *keep,
        n_words.alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.regexp_replace("_t", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_w")).alias("n_repeat_words"),
        n_lines.alias("n_lines"),
        F.size(F.filter("_w", lambda w: F.lower(w).isin(stop))).cast("long").alias("n_stop_words"),
        F.size(F.filter("_w", lambda w: w.rlike(r"\p{L}"))).cast("long").alias("n_alphabetic"),
        F.size(F.filter("_l", lambda x: x.rlike(r"^\s*[-*•‣–]\s"))).cast("long").alias("n_bullets"),
        F.size(F.filter("_l", lambda x: x.rlike(r"(\.\.\.|…)\s*$"))).cast("long").alias("n_ellipses"),
    )
    c = F.col
    ratios = counts.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        _ratio(c("word_chars"), c("n_words")).alias("mean_word_chars"),
        _ratio(c("n_symbols"), c("n_words")).alias("symbol_ratio"),
        _ratio(c("n_stop_words"), c("n_words")).alias("stop_word_ratio"),
        _ratio(c("n_alphabetic"), c("n_words")).alias("alphabetic_ratio"),
        _ratio(c("n_dup_lines"), c("n_lines")).alias("duplicate_line_ratio"),
        _ratio(c("n_bullets"), c("n_lines")).alias("bullet_line_ratio"),
        _ratio(c("n_ellipses"), c("n_lines")).alias("ellipsis_line_ratio"),
        ((c("n_words") < 50) | (100 * c("n_repeat_words") > 50 * c("n_words"))).alias("base_failed"),
    )
    # The last term is always true. It keeps the optimizer from pushing a filter on the verdict below the projections,
    # where every metric would be computed again for each place that names it.
    once = F.monotonically_increasing_id() >= 0
    return ratios.withColumn("kept", ~c("base_failed") & compiled(thresholds) & once)


def filtered(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows that pass, with their own columns only."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    judged = measured(docs.select(row, F.col(f"`{text}`").alias("_text")), text="_text", keep=("_row",))
    return judged.where("kept").select("_row.*")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measured(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _sql() -> str:
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    bounds = " AND ".join(f"{t.metric} {op} {v}" for t in THRESHOLDS for op, v in ((">=", t.low), ("<=", t.high)) if v is not None)
    return rf"""
WITH a AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
v AS (SELECT row_number() OVER () AS r, * FROM a),
g AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM v, unnest(range(1, len(w) - 1)) AS u(i) WHERE len(w) >= 3),
d AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g),
p AS (SELECT r, i, lag(i, 1, -9) OVER (PARTITION BY r ORDER BY i) AS b FROM d WHERE n > 1),
c AS (SELECT r, sum(least(3, i - b))::BIGINT AS n_repeat_words FROM p GROUP BY r),
m AS (
  SELECT v.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(l) AS n_lines,
         len(list_filter(w, lambda x: lower(x) IN ({stop}))) AS n_stop,
         len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_alpha,
         len(list_filter(l, lambda x: regexp_matches(x, '^\s*[-*•‣–]\s'))) AS n_bullets,
         len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) AS n_ellipses
  FROM v LEFT JOIN c ON v.r = c.r),
q AS (
  SELECT *, CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars,
         CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbol_ratio,
         CASE WHEN n_words > 0 THEN n_stop / n_words ELSE 0 END AS stop_word_ratio,
         CASE WHEN n_words > 0 THEN n_alpha / n_words ELSE 0 END AS alphabetic_ratio,
         CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS duplicate_line_ratio,
         CASE WHEN n_lines > 0 THEN n_bullets / n_lines ELSE 0 END AS bullet_line_ratio,
         CASE WHEN n_lines > 0 THEN n_ellipses / n_lines ELSE 0 END AS ellipsis_line_ratio,
         (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, (NOT base_failed AND {bounds}) AS kept FROM q
"""


QUERIES = {"op7_quality_rules": op7_quality_rules}
SQL = {"op7_quality_rules": _sql()}
