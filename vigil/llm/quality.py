"""Quality rules and a hashed n-gram log-likelihood ratio, in SQL functions only.

Two multinomials over hashed word uni- and bigrams are counted: the raw corpus
(every row of the documents) and the trusted target (the rows whose doc_id is
in ``trusted``). A document's score is the sum of log(p_target / p_raw) over
its n-grams divided by their number; it is kept when the score reaches a fixed
threshold and the base rules hold. Counts cover all rows and whole texts. The
number of buckets bounds the weight table, which reaches the scoring scan as
one scalar subquery of ``buckets`` doubles.

Defined cases: null and empty texts have no words, score 0.0 and fail the base
rules; a null doc_id is never trusted but its text counts as raw; repeated
rows count and are returned as often as they occur; an empty table gives an
empty result, an empty trusted set makes every ratio 1 (score 0.0). A
document is trusted when any of its label rows says so. Extra columns are
ignored unless named in ``keep``.

The repeated windows are compared by 64-bit hashes within one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import kept, words

BUCKETS = 1 << 16
SMOOTHING = 10.0
THRESHOLD = -0.1
#: Rows without a key get one of so many join salts.
NULL_SALTS = 1024
SYMBOLS = "#*$%&|<>"
GAP_CHARS = "\x20\x09\x0a\x0b\x0c\x0d"

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def _after(a: Column, k: int) -> Column:
    """The array without its first ``k`` elements."""
    return F.slice(a, F.lit(k + 1), F.size(a) + 1)


def _with_later(a: Column, b: Column, step: int, f) -> Column:
    """``f`` over each element of ``a`` and that of ``b`` ``step`` places on; what has none is cut off."""
    made = F.transform(a, lambda x, k: f(x, F.get(b, k + step)))
    return F.slice(made, F.lit(1), F.greatest(F.size(b) - step, F.lit(0)))


def _repeats(a: Column) -> Column:
    """Whether an element of the array occurs twice."""
    return F.size(F.array_distinct(a)) < F.size(a)


def _without(t: Column, chars: str) -> Column:
    for c in chars:
        t = F.replace(t, F.lit(c), F.lit(""))
    return t


def _pairs(a: Column, b: Column, f) -> Column:
    """``f`` over elements in step; what sticks out is cut off."""
    return F.slice(F.zip_with(a, b, f), F.lit(1), F.least(F.size(a), F.size(b)))


def with_words(df: DataFrame, text: str) -> DataFrame:
    """Adds ``_t`` (text, null as empty), ``_w`` (words) and ``_b`` (64-bit
    hashes of neighbouring words)."""
    df = df.withColumn("_t", F.coalesce(F.col(text).cast("string"), F.lit("")))
    df = df.withColumn("_w", words(F.col("_t")))
    w = F.col("_w")
    return df.withColumn("_b", _with_later(w, w, 1, lambda a, b: F.xxhash64(a, b)))


def with_base(df: DataFrame) -> DataFrame:
    """The base figures and ``base_failed`` of rows that have the word columns."""
    t, w, b = F.col("_t"), F.col("_w"), F.col("_b")
    df = df.select(
        "*", F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(_without(t, SYMBOLS))).cast("long").alias("n_symbols"),
        F.array_remove(F.split(t, "\n"), "").alias("_lines"),
        _with_later(b, w, 2, lambda h, c: F.xxhash64(h, c)).alias("_h"))
    # Most texts repeat no line and no window: only the others need the exact count.
    full = F.filter("_lines", lambda line: F.translate(line, GAP_CHARS, "") != "")
    df = df.select(
        "*", F.when(_repeats(F.col("_lines")), full).otherwise(F.array().cast("array<string>")).alias("_full"),
        F.when(_repeats(F.col("_h")), F.sort_array(F.transform("_h", lambda h, k: F.struct(h.alias("h"), k.alias("k")))))
        .otherwise(F.array().cast("array<struct<h:bigint,k:int>>")).alias("_s"))
    s = F.col("_s")
    twice = _pairs(s, _after(s, 1), lambda x, y: F.when(x["h"] == y["h"], F.array(x["k"], y["k"])))
    df = df.select(
        "*", (F.size("_full") - F.size(F.array_distinct("_full"))).cast("long").alias("n_dup_lines"),
        F.sort_array(F.array_distinct(F.flatten(F.filter(twice, lambda x: x.isNotNull())))).alias("_p"))
    p = F.col("_p")
    # A window covers three words; one that starts d words before the next adds min(3, d).
    spans = F.zip_with(p, _after(p, 1), lambda x, y: F.coalesce(F.least(F.lit(3), y - x), F.lit(3)))
    df = df.withColumn("n_repeat_words", F.aggregate(spans, F.lit(0), lambda x, y: x + y).cast("long"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return df.withColumn("base_failed", failed).drop("_lines", "_h", "_full", "_s", "_p")


def ngram_buckets(buckets: int) -> Column:
    n = F.lit(buckets)
    return F.concat(F.transform(F.col("_w"), lambda x: F.pmod(F.xxhash64(x), n).cast("int")),
                    F.transform(F.col("_b"), lambda x: F.pmod(x, n).cast("int")))


def ratio_table(docs: DataFrame, trusted: DataFrame, text: str, buckets: int, smoothing: float) -> DataFrame:
    """One row with ``ratios``: log(p_target / p_raw) by bucket."""
    # Always 0, but not a literal: the join then deals rows out by the salt as well.
    zero = F.pmod(F.col("doc_id").cast("long"), F.lit(1)).cast("int")
    ids = trusted.select("doc_id", zero.alias("_salt"), F.lit(1).alias("_trusted")).distinct()
    salt = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64(F.col(text).cast("string")), F.lit(NULL_SALTS)))
    # Always a sort-merge join: the plan, and what it shuffles, is the same at every size.
    rows = (docs.select("doc_id", text, F.coalesce(salt, F.lit(0)).cast("int").alias("_salt"))
            .join(ids.hint("merge"), ["doc_id", "_salt"], "left"))
    counts = (with_words(rows, text)
              .select("_trusted", F.explode(ngram_buckets(buckets)).alias("bucket"))
              .groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count("_trusted").alias("target")))
    # From here on at most ``buckets`` rows.
    every = (docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
             .join(counts, "bucket", "left").na.fill(0, ["raw", "target"]))
    rows = (every.groupBy().agg(F.sort_array(F.collect_list(F.struct("bucket", "raw", "target"))).alias("c"),
                                F.sum("raw").alias("n_raw"), F.sum("target").alias("n_target")))
    # Both counts get the same share of pseudo-counts, so that a bucket that
    # was hardly seen says nothing (ratio 1) at every corpus size.
    a, rho = F.lit(smoothing), F.col("n_raw") / F.col("n_target")
    ratio = F.transform("c", lambda x: F.log((x["target"] + a) * rho / (x["raw"] + a * rho)))
    neutral = F.transform("c", lambda x: F.lit(0.0))
    return rows.select(F.when(F.col("n_target") > 0, ratio).otherwise(neutral).alias("ratios"))


def quality(docs: DataFrame, trusted: DataFrame, text: str = "text", keep=("doc_id",), buckets: int = BUCKETS,
            smoothing: float = SMOOTHING, threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` columns, the base figures, ``score`` and ``kept``. ``trusted``
    has the doc_id of the trusted documents."""
    own = kept(docs, keep, (*BASE, "score", "kept"))
    ratios = ratio_table(docs, trusted, text, buckets, smoothing).scalar()
    text_col = [] if text in own else [text]
    df = with_base(with_words(docs.select(*own, *text_col), text))
    grams = df.select("*", ngram_buckets(buckets).alias("_g"), ratios.alias("_r"))
    total = F.aggregate("_g", F.lit(0.0), lambda acc, k: acc + F.get(F.col("_r"), k))
    score = F.when(F.size("_g") > 0, total / F.size("_g")).otherwise(F.lit(0.0))
    scored = grams.withColumn("score", score).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
    # As a generated row, so that a caller's filter on a result is not pushed
    # into the expressions, which would then be computed several times over.
    made = F.inline(F.array(F.struct(*BASE, "score", "kept")))
    return scored.select(*own, made)


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.filter(F.col("quality") == 1).select("doc_id")
