"""Word-level BPE with word ends over whole batches, and the exact length histogram.

The vocabulary drops white space, so a text's ids are those of its words in order. A worker
encodes a word once: those of plain letters, digits and marks by applying the merges to all new
words at once in numpy, others by the tokenizers library, which the tests hold all ids against.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.common import text_runs, word_bounds, word_keys

# Bytes of words that numpy can lower and split: graphic ASCII without the apostrophe, and the
# letters U+00C0 to U+00FF, whose class and lower case are the same in every Unicode version.
_PLAIN = np.zeros(256, bool)
_PLAIN[0x21:0x7F] = True
_PLAIN[[0x27, 0x7C]] = False
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0xC0), 0xC3]] = True
END = "</w>"
# Words that a task keeps encoded between slices (some 50 bytes each), and bytes of their ids. The
# work on a slice of a megabyte takes some 100 MB more.
KEPT_WORDS = 400_000
KEPT_BYTES = 32 << 20
_NONE = np.int64(1 << 40)


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_characters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    shown = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [shown[b] for b in range(256)]


class WordBpe:
    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        model = json.load(open(path, encoding="utf-8"))["model"]
        vocab = model["vocab"]
        self.size = max(vocab.values()) + 1
        chars = _byte_characters()
        self.inner = np.array([vocab[c] for c in chars], np.int64)
        self.last = np.array([vocab[c + END] for c in chars], np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        # rank and product of a pair, in an open table: a pair lies at its slot or soon after
        self.slots = 1 << 20
        self.key = np.full(self.slots + 64, -1, np.int64)
        self.rank = np.full(self.slots + 64, _NONE, np.int64)
        self.made = np.zeros(self.slots + 64, np.int64)
        for i in order:
            at = int(self._slot(keys[i : i + 1])[0])
            while self.key[at] >= 0 and self.key[at] != keys[i]:
                at += 1
            if self.key[at] < 0:
                self.key[at], self.rank[at], self.made[at] = keys[i], i, made[i]
        self.forget()

    def forget(self) -> None:
        """Known words: their hashes in order, and where the ids of each lie."""
        self.known = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(44)).astype(np.int64)

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (or a very large number) and product of each pair."""
        keys = left * self.size + right
        at = self._slot(keys)
        have = self.key[at]
        more = np.flatnonzero((have != keys) & (have >= 0))
        while len(more):
            at[more] += 1
            have = self.key[at[more]]
            more = more[(have != keys[more]) & (have >= 0)]
        found = self.key[at] == keys
        return np.where(found, self.rank[at], _NONE), self.made[at]

    def merged(self, text: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of non-empty pieces, one after the other, and where each piece begins."""
        ids = self.inner[text]
        ends = np.cumsum(lengths)
        ids[ends - 1] = self.last[text[ends - 1]]
        owner = np.repeat(np.arange(len(lengths)), lengths)
        done_ids, done_owner = [], []
        rank = np.full(len(ids), _NONE)
        made = np.zeros(len(ids), np.int64)
        inside = np.flatnonzero(owner[:-1] == owner[1:])
        rank[inside], made[inside] = self._look_up(ids[inside], ids[inside + 1])
        while len(ids):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[first, len(ids)])
            least = np.minimum.reduceat(rank, first)
            going = np.repeat(least < _NONE, sizes)
            if not going.all():
                done_ids.append(ids[~going])
                done_owner.append(owner[~going])
                ids, owner, rank, made = ids[going], owner[going], rank[going], made[going]
                sizes, least = sizes[least < _NONE], least[least < _NONE]
                if not len(ids):
                    break
            # the first pair of least rank in each piece
            hits = np.flatnonzero(rank == np.repeat(least, sizes))
            hits = hits[np.r_[True, owner[hits[1:]] != owner[hits[:-1]]]]
            ids[hits] = made[hits]
            keep = np.ones(len(ids), bool)
            keep[hits + 1] = False
            shift = hits - np.arange(len(hits))  # where the new ids are once the others are gone
            ids, owner, rank, made = ids[keep], owner[keep], rank[keep], made[keep]
            for at in (shift, shift - 1):
                at = at[at >= 0]
                rank[at] = _NONE
                at = at[at + 1 < len(ids)]
                at = at[owner[at] == owner[at + 1]]
                rank[at], made[at] = self._look_up(ids[at], ids[at + 1])
        if not done_ids:
            return np.zeros(0, np.int64), np.zeros(len(lengths) + 1, np.int64)
        owner = np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        bounds = np.searchsorted(owner[order], np.arange(len(lengths) + 1))
        return np.concatenate(done_ids)[order], bounds

    def _plain_words(
        self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids and lengths in ids of words of plain bytes: lowered, split and merged in numpy."""
        sizes = ends - starts
        begun = np.cumsum(sizes) - sizes
        at = np.repeat(starts - begun, sizes) + np.arange(int(sizes.sum()))
        own = text[at].copy()
        second = np.zeros(len(own), bool)
        second[1:] = own[:-1] == 0xC3
        upper = ((own >= 0x41) & (own <= 0x5A)) | (second & (own <= 0x9E))
        own[upper] += 0x20
        # pieces: runs of letters, single digits, runs of anything else
        kind = np.where(_LETTER[own], 0, 1)
        digit = (own >= 0x30) & (own <= 0x39)
        head = np.ones(len(own), bool)
        head[1:] = (kind[1:] != kind[:-1]) | digit[1:] | digit[:-1]
        head[begun] = True
        first = np.flatnonzero(head)
        ids, bounds = self.merged(own, np.diff(np.r_[first, len(own)]))
        pieces = np.searchsorted(first, np.r_[begun, len(own)])
        return ids.astype(np.uint32), np.diff(bounds[pieces])

    def _learn(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> None:
        """Encode distinct new words and keep their ids."""
        second = np.zeros(len(text) + 1, bool)
        second[1:] = text == 0xC3
        second = second[:-1]
        good = _PLAIN[text] | (text == 0xC3)
        good[second] = (text[second] >= 0x80) & (text[second] <= 0xBF)
        good[second] &= (text[second] != 0x97) & (text[second] != 0xB7)
        bad = np.r_[0, np.cumsum(~good)]
        plain = bad[ends] == bad[starts]
        ids, sizes = self._plain_words(text, starts[plain], ends[plain])
        order = np.r_[np.flatnonzero(plain), np.flatnonzero(~plain)]
        whole = text.tobytes()
        rest = [
            np.array(self.library.encode(whole[a:b].decode(), add_special_tokens=False).ids, np.uint32)
            for a, b in zip(starts[~plain].tolist(), ends[~plain].tolist(), strict=True)
        ]
        sizes = np.r_[sizes, np.array([len(x) for x in rest], np.int64)]
        at = np.cumsum(sizes) - sizes + len(self.ids)
        self.ids = np.concatenate([self.ids, ids, *rest])
        known = np.r_[self.known, keys[order]]
        by_key = np.argsort(known, kind="stable")
        self.known = known[by_key]
        self.at = np.r_[self.at, at][by_key]
        self.length = np.r_[self.length, sizes][by_key]

    def _place(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.known, keys)
        inside = np.minimum(at, max(len(self.known) - 1, 0))
        return at, (self.known[inside] == keys) if len(self.known) else np.zeros(len(keys), bool)

    def encode(self, text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text's begin."""
        starts, ends, words_before = word_bounds(text, offsets)
        keys = word_keys(text, starts, ends)
        distinct, sample, code = np.unique(keys, return_index=True, return_inverse=True)
        at, found = self._place(distinct)
        if not found.all():
            new = sample[~found]
            if len(self.known) > KEPT_WORDS or self.ids.nbytes > KEPT_BYTES:
                self.forget()
                new = sample
            self._learn(text, starts[new], ends[new], keys[new])
            at, _ = self._place(distinct)
        size = self.length[at][code]
        begun = np.cumsum(size) - size
        total = int(size.sum())
        ids = self.ids[np.repeat(self.at[at][code] - begun, size) + np.arange(total)]
        return ids, np.r_[begun, total][words_before]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordBpe:
    """One encoder for each worker process."""
    return WordBpe(path)


def encoded_runs(batch: pa.RecordBatch, text_col: int, path: str) -> Iterator[tuple]:
    """(first row, ids, bounds) for slices of a batch's texts. A null text counts as empty."""
    for first, text, offsets in text_runs(batch.column(text_col)):
        yield first, *encoder(path).encode(text, offsets)


def encoded_lengths(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None
) -> DataFrame:
    """(id, n_tokens) of every document. A null text has no tokens; repeated rows stay."""
    path = path or vocabulary_path()
    kind = docs.schema[id_col].dataType

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, bounds in encoded_runs(batch, 1, path):
                n = len(bounds) - 1
                yield pa.record_batch(
                    [batch.column(0).slice(first, n), pa.array(np.diff(bounds), pa.int64())],
                    [id_col, "n_tokens"],
                )
        encoder(path).forget()  # a worker outlives its tasks

    rows = docs.select(id_col, text_col)
    return rows.mapInArrow(lengths, f"`{id_col}` {kind.simpleString()}, n_tokens long")


QUANTILES = (0.5, 0.9, 0.99)


def length_histogram(lengths: DataFrame, n_col: str = "n_tokens") -> DataFrame:
    """The exact histogram of lengths with its suffix sums: one row for each length that occurs.

    ``n_docs`` documents have just ``length`` tokens; ``docs_from`` and ``tokens_from`` count those
    with as many or more. A context limit equal to the length keeps ``truncated_total`` tokens
    in all, and ``share_within`` of the documents are no longer than it; quantiles are the least
    lengths whose share reaches them. Any other limit follows from the row below it, by
    ``truncated_total + (limit - length) * (docs_from - n_docs)``. Null lengths are left out.
    The sums run over distinct lengths: documents are counted before any exchange.
    """
    counts = (
        lengths.filter(F.col(n_col).isNotNull())
        .groupBy(F.col(n_col).alias("length"))
        .agg(F.count(F.lit(1)).alias("n_docs"))
    )
    return with_suffix_sums(counts)


# Lengths that one window of suffix sums takes.
BAND = 256


def with_suffix_sums(counts: DataFrame) -> DataFrame:
    """Suffix sums in two steps: within bands of lengths, and over the bands' totals."""
    banded = counts.withColumn("band", F.floor(F.col("length") / BAND))
    within = Window.partitionBy("band").orderBy(F.col("length").desc())
    tokens = F.col("length") * F.col("n_docs")
    inner = banded.select(
        "*", F.sum("n_docs").over(within).alias("d"), F.sum(tokens).over(within).alias("t")
    )
    bands = banded.groupBy("band").agg(
        F.sum("n_docs").alias("bd"), F.sum(tokens).alias("bt")
    )
    above = Window.orderBy(F.col("band").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.col("band").desc()).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    bands = bands.select(
        "band",
        F.coalesce(F.sum("bd").over(above), F.lit(0)).alias("d_above"),
        F.coalesce(F.sum("bt").over(above), F.lit(0)).alias("t_above"),
        F.sum("bd").over(whole).alias("d_all"),
        F.sum("bt").over(whole).alias("t_all"),
    )
    out = inner.join(bands, "band").select(
        "length",
        "n_docs",
        (F.col("d") + F.col("d_above")).alias("docs_from"),
        (F.col("t") + F.col("t_above")).alias("tokens_from"),
        "d_all",
        "t_all",
    )
    within_share = (F.col("d_all") - F.col("docs_from") + F.col("n_docs")) / F.col("d_all")
    before = (F.col("d_all") - F.col("docs_from")) / F.col("d_all")
    quantile = F.lit(None).cast("double")
    for q in QUANTILES:
        quantile = F.when((before < q) & (within_share >= q), F.lit(q)).otherwise(quantile)
    return out.select(
        "length",
        "n_docs",
        "docs_from",
        "tokens_from",
        (F.col("t_all") - F.col("tokens_from") + F.col("length") * F.col("docs_from")).alias(
            "truncated_total"
        ),
        within_share.alias("share_within"),
        quantile.alias("quantile"),
    )
