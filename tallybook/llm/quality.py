"""Quality rules: hashed n-gram log-likelihood ratio of a trusted target against the raw corpus.

Both are multinomials over ``BUCKETS`` buckets of hashed words and word pairs. A little is added to every
raw count, and ``PRIOR`` n-grams spread like the raw corpus to the target's, so that a target like
the raw corpus gives ratios of 0 however short its list is, and a short list moves them little. A
document's score is the mean over its n-grams of the log of target probability
over raw probability, and a document is kept if its score reaches a threshold. All of it is
DataFrame functions: no Python runs on the executors.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import words

BUCKETS = 1 << 14
# What is added to each raw count (every judged document is part of the raw corpus, so this only
# matters for buckets that occur nowhere).
ADDED = 1 / 16
# N-grams of the raw corpus's distribution that are added to the target.
PRIOR = 1 << 14
# Mean log ratio per n-gram from which a document is kept, or the ratio's own level if lower.
THRESHOLD = -0.12
# Labelled documents that make up the trusted target, chosen by a hash of their identifier.
TRUSTED_ROWS = 16_384
# Share of the trusted documents that may score less than the ratio's level, and how far below a
# negative level documents are still kept, as they may be of kinds that no trusted one shows.
LEVEL_SHARE = 0.01
LEVEL_MARGIN = 1.25
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "[#*$%&|<>]"


def buckets(hashes: Column) -> Column:
    """The buckets of all words and word pairs, from the words' hashes."""
    pairs = F.zip_with(F.slice(hashes, F.lit(1), _pairs(hashes)), _next(hashes), _pair_bucket)
    return F.concat(F.transform(hashes, _bucket), pairs)


def _pairs(hashes: Column) -> Column:
    return F.greatest(F.size(hashes) - 1, F.lit(0))


def _next(hashes: Column) -> Column:
    """From the second word on."""
    return F.slice(hashes, F.lit(2), _pairs(hashes))


def _bucket(h: Column) -> Column:
    return F.pmod(h, F.lit(BUCKETS)).cast("int")


def _pair_bucket(a: Column, b: Column) -> Column:
    return _bucket(F.xxhash64(a, b))


def word_hashes(found: Column) -> Column:
    return F.transform(found, lambda w: F.xxhash64(w))


@dataclass(frozen=True)
class Ratio:
    """Log ratio of each bucket, in order, and the score that the trusted documents reach when
    each is judged by the others."""

    logs: tuple[float, ...]
    level: float = 0.0

    def column(self) -> Column:
        return _literal(self.logs)


def _literal(values: Sequence[float]) -> Column:
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def fit(
    docs: DataFrame,
    trusted: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    trusted_id: str = "doc_id",
    rows: int = TRUSTED_ROWS,
) -> Ratio:
    """The ratio between the documents listed in ``trusted`` and all documents.

    The raw corpus is counted over all documents. Of the trusted identifiers the ``rows`` first
    in the order of their hash count as target: a bounded list, which is broadcast, so that no
    text is shuffled. Counts are added up before the exchange, one row per bucket and task;
    the driver gets one row per bucket. Without any trusted document all ratios are 0. The fewer
    n-grams the trusted documents have, the nearer to 0 the ratios: n of them can lower a
    document's score to log(PRIOR / (n + PRIOR)) at most.
    """
    ids = trusted.select(F.col(trusted_id).alias("_trusted")).filter("_trusted is not null").distinct()
    ids = ids.orderBy(F.xxhash64("_trusted"), "_trusted").limit(rows)
    marked = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(
        F.broadcast(ids), F.col("_id") == F.col("_trusted"), "left"
    )
    hashed = marked.select(
        F.col("_trusted").isNotNull().cast("long").alias("t"), word_hashes(words(F.col("_text"))).alias("h")
    )
    grams = hashed.select("t", F.explode(buckets(F.col("h"))).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.sum("t").alias("target"), F.count(F.lit(1)).alias("raw"))
    found = {r["bucket"]: (r["target"], r["raw"]) for r in counts.collect()}
    targets, raws = sum(t for t, _ in found.values()), sum(r for _, r in found.values())
    if not targets:
        return Ratio((0.0,) * BUCKETS)
    in_target = [float(found.get(i, (0, 0))[0]) for i in range(BUCKETS)]
    usual = [(found.get(i, (0, 0))[1] + ADDED) / (raws + ADDED * BUCKETS) for i in range(BUCKETS)]
    logs = [math.log((t + PRIOR * q) / (targets + PRIOR) / q) for t, q in zip(in_target, usual, strict=True)]

    # each trusted document by the others: its own n-grams are taken out of the target first
    own = marked.filter("_trusted is not null").select(
        F.monotonically_increasing_id().alias("row"), buckets(word_hashes(words(F.col("_text")))).alias("b")
    )
    spread = own.select("row", F.size("b").alias("d"), F.explode("b").alias("bucket"))
    spread = spread.groupBy("row", "d", "bucket").agg(F.count(F.lit(1)).alias("n"))
    t, q = F.get(_literal(in_target), F.col("bucket")), F.get(_literal(usual), F.col("bucket"))
    without = F.log((t - F.col("n") + PRIOR * q) / (F.lit(targets) - F.col("d") + PRIOR) / q)
    scores = spread.groupBy("row").agg((F.sum(F.col("n") * without) / F.first("d")).alias("s"))
    level = scores.agg(F.percentile_approx("s", LEVEL_SHARE, 100_000)).first()[0]
    return Ratio(tuple(round(x, 6) for x in logs), round(level, 6))


def triples(hashes: Column) -> Column:
    """Hashes of the windows of three words."""
    return F.transform(
        F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - 2, F.lit(0))),
        lambda h, i: F.xxhash64(h, F.get(hashes, i + 1), F.get(hashes, i + 2)),
    )


def base_rules(rows: DataFrame) -> DataFrame:
    """Adds the base counts to rows with ``text_``, ``words_`` and ``hashes_``, and ``base_failed``.

    For the words in repeated windows, the windows are sorted by the high 40 bits of their hash
    with their place below; those whose neighbour has the same bits are compared again by the
    whole hash, a handful in most texts.
    """
    text = F.coalesce(F.col("text_"), F.lit(""))
    rows = rows.withColumn("triples_", triples(F.col("hashes_")))
    # texts all of whose windows differ, which most are, need no sorting
    repeats = F.size(F.array_distinct("triples_")) < F.size("triples_")
    none = F.array().cast("array<bigint>")
    rows = rows.withColumn("triples_", F.when(repeats, F.col("triples_")).otherwise(none))
    place = F.lit((1 << 24) - 1).cast("long")
    rows = rows.withColumn(
        "sorted_",
        F.sort_array(
            F.transform(
                F.col("triples_"),
                lambda t, i: t.bitwiseAND(F.lit(-1 << 24)).bitwiseOR(i.cast("long").bitwiseAND(place)),
            )
        ),
    )

    def high(x: Column) -> Column:
        return F.shiftright(x, 24)

    s = F.col("sorted_")
    rows = rows.withColumn(
        "near_",
        F.filter(
            s,
            lambda x, i: F.coalesce(high(F.get(s, i - 1)) == high(x), F.lit(False))
            | F.coalesce(high(F.get(s, i + 1)) == high(x), F.lit(False)),
        ),
    )
    few = F.transform(
        F.col("near_"),
        lambda x: F.struct(
            F.get(F.col("triples_"), x.bitwiseAND(place).cast("int")).alias("t"),
            x.bitwiseAND(place).cast("int").alias("at"),
        ),
    )
    # texts of 2**24 words or more: every window is a candidate
    every = F.transform(F.col("triples_"), lambda t, i: F.struct(t.alias("t"), i.alias("at")))
    long_text = F.size("triples_") >= (1 << 24)
    rows = rows.withColumn("pairs_", F.sort_array(F.when(long_text, every).otherwise(few)))
    p = F.col("pairs_")
    twice = F.filter(
        p,
        lambda x, i: F.coalesce(F.get(p, i - 1)["t"] == x["t"], F.lit(False))
        | F.coalesce(F.get(p, i + 1)["t"] == x["t"], F.lit(False)),
    )
    rows = rows.withColumn("at_", F.sort_array(F.transform(twice, lambda x: x["at"])))
    a = F.col("at_")
    # each window adds the words up to the next one, three at most
    steps = F.transform(a, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(a, i + 1) - x, F.lit(3))))
    covered = F.aggregate(steps, F.lit(0).cast("long"), lambda acc, x: acc + x)
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumn("lines_", lines)
    n_words = F.size("hashes_").cast("long")
    rows = rows.select(
        "*",
        n_words.alias("n_words"),
        F.length(F.array_join("words_", "")).cast("long").alias("word_chars"),
        (F.size(F.split(text, SYMBOLS, -1)) - 1).cast("long").alias("n_symbols"),
        (F.size("lines_") - F.size(F.array_distinct("lines_"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return rows.withColumn("base_failed", failed)


def judge(
    docs: DataFrame,
    ratio: Ratio,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float | None = None,
) -> DataFrame:
    """Counts, ``base_failed``, ``score`` and ``kept`` of every document.

    A null or empty text has no words, fails the base rules and has no score. A document that
    fails them is not kept; any other is kept if its score is ``threshold`` or more: by default ``THRESHOLD``, or ``LEVEL_MARGIN``
    times the ratio's level where that is lower, as it is with a list too short to show all kinds of trusted documents. The score
    rests on the whole text and on nothing else, so equal texts get equal verdicts and repeated
    rows stay. Nothing is shuffled. An empty table gives no rows; other columns play no part,
    whatever their names. Texts of any length are judged whole; a task holds some 50 bytes per word
    of the longest.
    """
    rows = docs.select(F.col(id_col), F.col(text_col).alias("text_"))
    rows = rows.withColumn("words_", words(F.col("text_")))
    rows = rows.withColumn("hashes_", word_hashes(F.col("words_")))
    rows = base_rules(rows)
    hashes, logs = F.col("hashes_"), ratio.column()

    def of_word_and_pair(a: Column, b: Column) -> Column:
        """The last word has no pair."""
        pair = F.when(b.isNull(), F.lit(0.0)).otherwise(F.get(logs, _pair_bucket(a, b)))
        return F.get(logs, _bucket(a)) + pair

    parts = F.zip_with(hashes, _next(hashes), of_word_and_pair)
    total = F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)
    score = F.when(F.col("n_words") > 0, total / (2 * F.col("n_words") - 1))
    if threshold is None:
        threshold = min(THRESHOLD, LEVEL_MARGIN * ratio.level)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    kept = ~F.col("base_failed") & (F.coalesce(F.col("score"), F.lit(0.0)) >= threshold)
    judged = rows.select(id_col, *names, F.round(score, 9).alias("score")).withColumn("kept", kept)
    # out of a generator, lest a filter on the verdict be pushed down with all that it rests on
    verdict = F.struct(*names, "score", "kept")
    return judged.select(id_col, F.inline(F.array(verdict)))
