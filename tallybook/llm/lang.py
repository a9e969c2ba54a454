"""Language identification in two steps: families first, then languages within a family.

Texts are vectors of hashed byte 1- to 4-grams. One linear support vector machine per family
tells it from the others; within a family, one machine per pair of languages votes. The machines
are fitted on a bounded sample of labelled rows and applied to whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.common import text_runs

UNKNOWN = "und"
DIMENSIONS = 4096
ORDERS = (1, 2, 3, 4)
# Labelled rows per language that the machines are fitted on, chosen by a hash of the identifier.
ROWS_PER_LANGUAGE = 200
# Texts whose vectors are held at a time.
TEXTS = 256

# Families of common language codes; a code not listed is a family of its own.
FAMILIES = {
    "germanic": ("da", "de", "en", "fy", "is", "nb", "nl", "nn", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "turkic": ("az", "kk", "tr", "uz"),
}


def family_of(lang: str) -> str:
    for family, langs in FAMILIES.items():
        if lang in langs:
            return family
    return lang


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_LOWER[[*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 0x20


def vectors(text: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of length one for each text: roots of the counts of its hashed n-grams.

    ASCII letters are lowered, all other ASCII counts as a space, and runs of spaces as one.
    """
    rows = len(offsets) - 1
    low = _LOWER[text]
    owner = np.repeat(np.arange(rows), np.diff(offsets))
    space = low == 0x20
    keep = np.ones(len(low), bool)
    keep[1:] = ~(space[1:] & space[:-1] & (owner[1:] == owner[:-1]))
    low, owner = low[keep].astype(np.uint64), owner[keep]
    counts = np.zeros(rows * DIMENSIONS)
    code = np.zeros(len(low), np.uint64)
    for order in range(1, max(ORDERS) + 1):
        n = len(low) - order + 1
        if n <= 0:
            break
        code = (code[:n] << np.uint64(8)) | low[order - 1 :]
        if order not in ORDERS:
            continue
        bucket = ((code + np.uint64(order << 40)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(52)
        within = owner[:n] == owner[order - 1 :]
        at = owner[:n][within] * DIMENSIONS + bucket[within].astype(np.int64)
        counts += np.bincount(at, minlength=len(counts))
    counts = np.sqrt(counts.reshape(rows, DIMENSIONS))
    norm = np.sqrt((counts * counts).sum(axis=1))
    return counts / np.where(norm > 0, norm, 1)[:, None]


def _vector_runs(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    for first, text, offsets in text_runs(texts):
        for at in range(0, len(offsets) - 1, TEXTS):
            own = offsets[at : at + TEXTS + 1]
            yield first + at, vectors(text[own[0] : own[-1]], own - own[0])


def fit_svm(x: np.ndarray, y: np.ndarray, cost: float = 4.0, turns: int = 40) -> np.ndarray:
    """Weights (the last one a constant's) of a linear machine for labels of -1 and 1.

    Dual coordinate descent for the hinge loss, classes weighed alike; the order is fixed.
    """
    x = np.hstack([x, np.ones((len(x), 1))])
    share = np.where(y > 0, (y < 0).sum(), (y > 0).sum()) / max(1, len(y))
    most = cost * 2 * np.maximum(share, 1e-3)
    square = (x * x).sum(axis=1)
    alpha, w = np.zeros(len(x)), np.zeros(x.shape[1])
    draw = np.random.default_rng(11)
    for _ in range(turns):
        changed = 0.0
        for i in draw.permutation(len(x)):
            slope = y[i] * (w @ x[i]) - 1
            new = min(max(alpha[i] - slope / square[i], 0.0), most[i])
            if new != alpha[i]:
                changed = max(changed, abs(new - alpha[i]))
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
        if changed < 1e-3:
            break
    return w


@dataclass(frozen=True)
class Model:
    families: tuple[str, ...]
    family_weights: np.ndarray  # one row per family, none for a single one
    languages: dict[str, tuple[str, ...]]
    pairs: dict[str, list[tuple[int, int, np.ndarray]]]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The language of each row and a score from 0 to 1."""
        x = np.hstack([x, np.ones((len(x), 1))])
        share = np.ones((len(x), 1))
        if len(self.families) > 1:
            margin = np.exp(4 * np.clip(x @ self.family_weights.T, -20, 20))
            share = margin / margin.sum(axis=1, keepdims=True)
        family = share.argmax(axis=1)
        names = np.empty(len(x), object)
        score = share[np.arange(len(x)), family]
        for f, name in enumerate(self.families):
            own = np.flatnonzero(family == f)
            langs = self.languages[name]
            votes = np.zeros((len(own), len(langs)))
            sure = np.zeros((len(own), len(langs)))
            for a, b, w in self.pairs[name]:
                p = 1 / (1 + np.exp(-4 * np.clip(x[own] @ w, -20, 20)))
                votes[:, a] += p >= 0.5
                votes[:, b] += p < 0.5
                sure[:, a] += p
                sure[:, b] += 1 - p
            best = (votes + sure / (len(langs) + 1)).argmax(axis=1)
            names[own] = np.array(langs, object)[best]
            if len(langs) > 1:
                score[own] *= sure[np.arange(len(own)), best] / (len(langs) - 1)
        return names.tolist(), np.clip(score, 0, 1)


def train(x: np.ndarray, langs: list[str]) -> Model:
    label = np.array(langs, object)
    families = tuple(sorted({family_of(a) for a in langs}))
    family = np.array([family_of(a) for a in langs], object)
    weights = [fit_svm(x, np.where(family == f, 1, -1)) for f in families] if len(families) > 1 else []
    languages, pairs = {}, {}
    for f in families:
        own = tuple(sorted({a for a in langs if family_of(a) == f}))
        languages[f] = own
        pairs[f] = []
        for (i, a), (j, b) in combinations(enumerate(own), 2):
            rows = np.flatnonzero((label == a) | (label == b))
            pairs[f].append((i, j, fit_svm(x[rows], np.where(label[rows] == a, 1, -1))))
    return Model(families, np.array(weights), languages, pairs)


# A score of no more than this is no better than guessing among a few languages.
LEAST_SCORE = 0.25


def rejected(lang_pred: Column, score: Column, text: Column, model: Model | None) -> Column:
    """Whether a prediction says that a text is in no known language: ``und``, or a score that is no
    better than a guess. Where nothing was learned only texts without a letter are rejected."""
    if model is None:
        return ~has_letter(text)
    return (lang_pred == UNKNOWN) | (score <= LEAST_SCORE)


def held_out(id_: Column) -> Column:
    """Whether crc32 of the identifier as text leaves no remainder by 5; null: not held out."""
    return F.coalesce(F.crc32(id_.cast("string")) % 5 == 0, F.lit(False))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows: int = ROWS_PER_LANGUAGE,
) -> Model | None:
    """The machines, from at most ``rows`` labelled documents of each language.

    Held-out documents, those without identifier, label or letters take no part. The sample is
    the first rows in the order of the identifier's hash; a first pass counts the labels, so
    that only some twice as many rows as wanted leave the scan. None without any label.
    """
    rank = F.xxhash64(F.lit("sample"), F.col(id_col))
    usable = docs.select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), rank.alias("rank"), F.col(id_col).alias("id")
    ).filter(
        F.col("lang").isNotNull() & F.col("id").isNotNull() & ~held_out(F.col("id")) & has_letter(F.col("text"))
    )
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not counts:
        return None
    limit = F.lit(None).cast("double")
    for lang, n in counts.items():
        share = min(1.0, (2 * rows + 20) / n)
        limit = F.when(F.col("lang") == lang, F.lit((2 * share - 1) * 2.0**63)).otherwise(limit)
    few = usable.filter(F.col("rank").cast("double") <= limit)
    order = Window.partitionBy("lang").orderBy("rank", "id", "text")
    few = few.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= rows).select("lang", "rank", "text")

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, x in _vector_runs(batch.column(2)):
                raw = pa.array([v.astype(np.float32).tobytes() for v in x], pa.binary())
                yield pa.record_batch(
                    [batch.column(0).slice(first, len(x)), batch.column(1).slice(first, len(x)), raw],
                    ["lang", "rank", "vector"],
                )

    sample = few.mapInArrow(measured, "lang string, rank long, vector binary").collect()
    sample.sort(key=lambda r: (r["lang"], r["rank"], bytes(r["vector"])))
    x = np.array([np.frombuffer(r["vector"], np.float32) for r in sample], np.float64)
    return train(x, [r["lang"] for r in sample])


def predict(
    docs: DataFrame,
    model: Model | None,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """(id, lang_pred, score) of every document, from its whole text alone, and columns to carry.

    A null text, or one without any letter, is ``und`` with score 0; so is every text where
    nothing was learned. Repeated rows stay, an empty table gives none. Carried columns keep their
    names, after the others, and may not be called lang_pred or score; any other column plays no
    part. The text itself may be carried and crosses to Python once. A text of any length is one
    vector; a task holds some 30 bytes per byte of the longest.
    """
    if {"lang_pred", "score"} & {id_col, *carry}:
        raise ValueError("carried columns may not be called lang_pred or score")
    names = [id_col, *[c for c in carry if c != text_col]]
    kinds = [docs.schema[c].dataType.simpleString() for c in names]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text_kind = {"text": docs.schema[text_col].dataType.simpleString()} if text_col in carry else {}
    out = ["lang_pred", "score", *[f"c{i}" for i in range(len(names))], *text_kind]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        for batch in batches:
            lettered = batch.column(1).to_pylist()
            for first, x in _vector_runs(batch.column(0)):
                n = len(x)
                lang, score = found.predict(x) if found else ([UNKNOWN] * n, np.zeros(n))
                ok = lettered[first : first + n]
                yield pa.record_batch(
                    [
                        pa.array([a if g else UNKNOWN for a, g in zip(lang, ok, strict=True)], pa.string()),
                        pa.array([float(s) if g else 0.0 for s, g in zip(score, ok, strict=True)], pa.float64()),
                        *[batch.column(2 + i).slice(first, n) for i in range(len(names))],
                        *([batch.column(0).slice(first, n)] if text_col in carry else []),
                    ],
                    out,
                )

    text = F.col(text_col)
    rows = docs.select(
        text.alias("text"),
        has_letter(text).alias("lettered"),
        *[F.col(c).alias(f"c{i}") for i, c in enumerate(names)],
    )
    numbered = {f"c{i}": k for i, k in enumerate(kinds)} | text_kind
    schema = ", ".join(["lang_pred string", "score double", *[f"{c} {k}" for c, k in numbered.items()]])
    held = {c: f"c{i}" for i, c in enumerate(names)} | {text_col: "text"}
    done = rows.mapInArrow(label, schema)
    return done.select(
        F.col("c0").alias(id_col), "lang_pred", "score", *[F.col(held[c]).alias(c) for c in carry]
    )
