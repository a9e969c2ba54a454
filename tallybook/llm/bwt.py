"""Substring deduplication over suffix order: common prefixes from a Burrows-Wheeler transform.

The corpus is cut into pieces around repeated anchors, and the pieces of an anchor meet in one
block. A block builds the Burrows-Wheeler transform of its distinct pieces and extends intervals
backwards, breadth first: the boundaries between suffixes that share exactly 0, 1, 2, ... bytes
are found in that order, each from those one shorter, and the search stops at the minimum
length. The suffixes left between two boundaries share that many bytes; the smallest document
among them keeps its copy.

An anchor is the least of the runs of ``ANCHOR`` bytes within a string of the minimum length, so
equal strings have equal anchors and meet in a block. A piece holds the strings that share one
anchor at one place, some 76 bytes at most, whatever the document's length.

The larger a corpus, the more pieces have an anchor in common and nothing beyond it. So a block
gives its transform only what may repeat: of each piece the part between the first and the last
string whose wider anchor, found in the same way, another piece has too; equal parts once.

An anchor that very many documents have, as one of a passage in a third of them, would make its
block hot. Its strings are compared one by one instead, each in the block
of its own hash, and a group sends each once for all of its documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import (
    byte_values,
    first_least,
    grouped,
    mix,
    partitions,
    prefix,
    spans,
    text_runs,
    unpacked,
    windows,
)
from tallybook.llm.rlz import covered

LENGTH = 50
# Bytes of an anchor: half a string, but no fewer than the first and no more than the second number.
LEAST_ANCHOR, ANCHOR = 16, 24
# Bytes of distinct pieces that one transform holds.
BLOCK_BYTES = 1 << 19
# An anchor is common if as many documents have it as this many partitions hold, and no fewer
# than the second number.
COMMON_PARTITIONS, COMMON_ROWS = 16, 1000
# A missing identifier ranks behind all others.
_LAST = np.iinfo(np.int64).max


def _block_of(keys: np.ndarray, blocks: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) % np.uint64(blocks)).astype(np.int32)


def _low(keys: np.ndarray) -> np.ndarray:
    return (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _in(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(keys), bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


def _heads(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.flatnonzero(new)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """The pieces in slices of some BLOCK_BYTES."""
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        upto = max(at + 1, int(np.searchsorted(ends, ends[at] + BLOCK_BYTES)))
        yield at, upto
        at = upto


def _gather(text: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([text[:0], *[text[_ranges(starts[a:b], sizes[a:b])] for a, b in _slices(sizes)]])


def suffix_order(text: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols. ``left``: symbols to the piece's end."""
    n = len(text)
    key = np.zeros(n, np.int64)
    for j in range(7):
        key <<= 9
        key[: n - j] |= np.where(left[: n - j] > j, text[j:], 0)
    have = 7
    while True:
        order = np.argsort(key, kind="stable")
        if have >= depth:
            return order
        ranked = key[order]
        rank = np.empty(n, np.int64)
        new = np.ones(n, np.int64)
        new[1:] = ranked[1:] != ranked[:-1]
        rank[order] = np.cumsum(new)
        key = rank * np.int64(n + 2)
        key[: n - have] += np.where(left[: n - have] > have, rank[have:], 0)
        have *= 2


def shared_prefixes(transform: np.ndarray, least: int) -> np.ndarray:
    """For each place in suffix order whether it shares fewer than ``least`` symbols with the one
    before it. Takes the transform alone: the symbols before the suffixes, in suffix order.

    The suffixes at p - 1 and p that begin with the same symbol share one more than the least
    shared between what follows them, which lies between their images. So a place's value is
    known one level after the first boundary between the images is.
    """
    n = len(transform)
    image = np.argsort(transform, kind="stable")  # from a suffix to the one that is a symbol shorter
    first = transform[image]
    parted = np.ones(n, bool)
    parted[1:] = (first[1:] != first[:-1]) | (first[1:] == 0)
    open_ = np.flatnonzero(~parted)
    upper, lower = image[open_], image[open_ - 1]
    for _ in range(1, least):
        before = np.cumsum(parted, dtype=np.int32)
        found = before[upper] != before[lower]
        if not found.any():
            break
        parted[open_[found]] = True
        stay = ~found
        open_, upper, lower = open_[stay], upper[stay], lower[stay]
    return parted


def least_ids(text: np.ndarray, sizes: np.ndarray, ids: np.ndarray, length: int) -> np.ndarray:
    """For each byte of the pieces the least id of a piece that has the ``length`` bytes from there.

    Bytes with fewer bytes left in their piece get no meaningful value.
    """
    m = len(sizes)
    ends = np.cumsum(sizes + 1) - 1  # each piece is closed by a symbol below all others
    closed = np.zeros(int(sizes.sum()) + m, np.int64)
    inner = np.ones(len(closed), bool)
    inner[ends] = False
    closed[inner] = text.astype(np.int64) + 1
    left = np.repeat(ends + 1, sizes + 1) - np.arange(len(closed))
    order = suffix_order(closed, left, length)
    parted = shared_prefixes(closed[order - 1].astype(np.uint16), length)
    owner = np.repeat(ids, sizes + 1)[order]
    starts = np.flatnonzero(parted)
    lowest = np.minimum.reduceat(owner, starts)
    out = np.empty(len(closed), np.int64)
    out[order] = np.repeat(lowest, np.diff(np.r_[starts, len(closed)]))
    return out[inner]


def _squeezed(text: np.ndarray) -> bytes:
    """Bytes compressed, after their number."""
    return len(text).to_bytes(8, "little") + pa.compress(text.tobytes(), "zstd", asbytes=True)


def _spread(texts: pa.ChunkedArray) -> np.ndarray:
    """All that a column holds so, one after the other."""
    out = [
        pa.decompress(x[8:], int.from_bytes(x[:8], "little"), "zstd", asbytes=True) for x in texts.to_pylist() if x
    ]
    return np.frombuffer(b"".join(out), np.uint8)


def _contents(text: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hashes of pieces that lie one after the other."""
    ends = np.cumsum(sizes)
    out = [np.zeros(0, np.uint64)]
    for a, b in _slices(sizes):
        first = ends[a] - sizes[a]
        own = ends[a:b] - first
        out.append(spans(prefix(byte_values(text[first : ends[b - 1]])), own - sizes[a:b], own))
    return np.concatenate(out)


def _runs(text: np.ndarray, offsets: np.ndarray, length: int, width: int) -> tuple:
    """Sums, and of each run of strings that share an anchor at one place its key, text, start and end.

    An anchor has ``width`` bytes; no string crosses texts.
    """
    sums, keys, pick, whole = _anchored(text, offsets, length, width)
    string = np.flatnonzero(whole)
    head = _heads(pick[string])
    last = np.r_[head[1:], len(string)][: len(head)] - 1
    start = string[head]
    row = np.searchsorted(offsets, start, "right") - 1
    return sums, keys[pick[start]], row, start, string[last] + length


def _shared_parts(
    anchors: np.ndarray, begun: np.ndarray, sizes: np.ndarray, text: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, start, end) of the parts that hold all strings that different pieces may share.

    Equal strings have equal wider anchors too, so a string whose wider anchor is alone among the
    pieces of its anchor is in one piece only. Pieces without any other string are left out.
    """
    found = [(np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)]
    for a, b in _slices(sizes):
        offsets = np.r_[0, np.cumsum(sizes[a:b])]
        _, key, row, start, end = _runs(
            _gather(text, begun[a:b], sizes[a:b]), offsets, length, length - length // 5
        )
        # adjacent pieces of a text overlap, so wider anchors are told apart by the pieces' own
        key = key + mix(anchors[a:b].astype(np.uint64))[row]
        found.append((key, a + row, start - offsets[row], end - offsets[row]))
    key, piece, start, end = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(key)
    again = key[order[1:]] == key[order[:-1]]
    repeated = np.zeros(len(key), bool)
    repeated[order[1:][again]] = repeated[order[:-1][again]] = True
    piece, start, end = piece[repeated], start[repeated], end[repeated]
    head = _heads(piece)
    return piece[head], start[head], end[np.r_[head[1:], len(piece)][: len(head)] - 1]


def _piece_spans(
    anchors: np.ndarray,
    sizes: np.ndarray,
    text: np.ndarray,
    many: np.ndarray,
    ids: np.ndarray,
    starts: np.ndarray,
    length: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(occurrence, start, end) of every span that a smaller document has as well.

    ``many`` occurrences of each piece follow one another in ``ids`` and ``starts``.
    """
    begun = np.cumsum(sizes) - sizes
    _, sample, same = np.unique(_contents(text, sizes), return_index=True, return_inverse=True)
    same = np.repeat(same, many)  # by occurrence
    lowest = np.full(len(sample), _LAST)
    np.minimum.at(lowest, same, ids)
    # an anchor with one content only needs no transform: equal strings have equal anchors
    anchor = anchors[sample]
    _, kinds, count = np.unique(anchor, return_inverse=True, return_counts=True)
    several = np.flatnonzero(count[kinds] > 1)
    several = several[np.argsort(anchor[several], kind="stable")]
    copy = np.flatnonzero(ids > lowest[same])
    out = [(copy, starts[copy], starts[copy] + np.repeat(sizes, many)[copy])]
    # in its smallest document a piece stays, but for strings that other pieces of a smaller one have
    keeper = np.flatnonzero(ids == lowest[same])
    keeper = keeper[np.argsort(same[keeper], kind="stable")]
    part, lower, upper = _shared_parts(
        anchor[several], begun[sample[several]], sizes[sample[several]], text, length
    )
    several = several[part]
    own, begin = upper - lower, begun[sample[several]] + lower
    # pieces that differ outside of their parts alone meet in one
    _, first, alike = np.unique(
        _contents(_gather(text, begin, own), own), return_index=True, return_inverse=True
    )
    by_anchor = np.argsort(first)
    first = first[by_anchor]
    alike = np.argsort(by_anchor)[alike]
    least = np.full(len(first), _LAST)
    np.minimum.at(least, alike, lowest[several])
    members = np.argsort(alike, kind="stable")
    bounds = np.searchsorted(alike[members], np.arange(len(first) + 1))
    part_anchor = anchor[several[first]]
    total = np.cumsum(own[first])
    at = 0
    while at < len(first):
        # whole anchors, some BLOCK_BYTES at a time
        upto = int(np.searchsorted(total, (total[at - 1] if at else 0) + BLOCK_BYTES, "right"))
        upto = max(upto, at + 1)
        while upto < len(first) and part_anchor[upto] == part_anchor[upto - 1]:
            upto += 1
        chosen = first[at:upto]
        value = least_ids(_gather(text, begin[chosen], own[chosen]), own[chosen], least[at:upto], length)
        # strings begin at all but the last bytes of a part
        among = members[bounds[at] : bounds[upto]]
        n = own[among] - length + 1
        base = (np.cumsum(own[chosen]) - own[chosen])[alike[among] - at]
        string = _ranges(base, n)
        piece = np.repeat(np.arange(len(among)), n)
        place = string - (base - lower[among])[piece]
        hit = np.flatnonzero(value[string] < lowest[several[among]][piece])
        if len(hit):
            new = np.ones(len(hit), bool)
            new[1:] = (hit[1:] != hit[:-1] + 1) | (piece[hit[1:]] != piece[hit[:-1]])
            head = np.flatnonzero(new)
            last = np.r_[head[1:], len(hit)] - 1
            who = several[among[piece[hit[head]]]]
            # every occurrence of the content in its smallest document
            a, b = (np.searchsorted(same[keeper], who, side) for side in ("left", "right"))
            row = np.repeat(np.arange(len(who)), b - a)
            occurrence = keeper[_ranges(a, b - a)]
            out.append(
                (
                    occurrence,
                    starts[occurrence] + place[hit[head]][row],
                    starts[occurrence] + place[hit[last]][row] + length,
                )
            )
        at = upto
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


_KEYS = "block int, grp int, keys binary, more binary, counts binary, n_docs long"
_KEYS_ARROW = pa.schema(
    [("block", pa.int32()), ("grp", pa.int32())]
    + [(c, pa.binary()) for c in ("keys", "more", "counts")]
    + [("n_docs", pa.int64())]
)
# Pieces and their occurrences, then single strings of common anchors.
_PARTS = ("keys", "sizes", "text", "many", "ids", "rows", "starts", "strings", "string_ids")
_CELL = "block int, grp int, " + ", ".join(f"{c} binary" for c in _PARTS)
_REPLY = "grp int, kind int, keys binary, ids binary, ends binary, strings binary, least binary"
_CELL_ARROW = pa.schema([("block", pa.int32()), ("grp", pa.int32())] + [(c, pa.binary()) for c in _PARTS])
_REPLY_ARROW = pa.schema(
    [("grp", pa.int32()), ("kind", pa.int32())]
    + [(c, pa.binary()) for c in ("keys", "ids", "ends", "strings", "least")]
)
# Kinds of replies: anchors found elsewhere (and which of them are common); spans to remove and the
# least documents of strings; a group's own note of where its common strings lie.
_SEEN, _SPAN, _OWN = range(3)


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.table([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema)


def _ordered(group: pa.Table) -> pa.Table:
    """The group's documents in an order that each pass finds again."""
    ids = group["doc"].to_numpy() if not group["doc"].null_count else None
    keys = [("doc", "ascending")]
    if ids is None or len(np.unique(ids)) < len(ids):
        keys.append(("text", "ascending"))
    return group.sort_by(keys)


def _ids(group: pa.Table) -> np.ndarray:
    return group["doc"].combine_chunks().fill_null(int(_LAST)).to_numpy().astype(np.int64)


def _anchored(text: np.ndarray, offsets: np.ndarray, length: int, width: int) -> tuple:
    """Sums, anchor keys, the anchor of each string and which strings lie within one text."""
    sums = prefix(byte_values(text))
    keys = windows(sums, width)
    pick = first_least(keys, length - width + 1)
    ends = np.repeat(offsets[1:], np.diff(offsets))[: len(pick)]
    return sums, keys, pick, np.arange(len(pick)) + length <= ends


def _by_block(where: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """The blocks that occur, each with the places of its keys, in order."""
    order = np.argsort(where, kind="stable")
    if not len(order):
        return []
    first = _heads(where[order])
    return [(int(where[order[a]]), order[a:b]) for a, b in zip(first, np.r_[first[1:], len(order)], strict=True)]


def drop_shared(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    carry: tuple[str, ...] = (),
    as_text: bool = False,
) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept) of every document; ``kept`` is binary, or, with
    ``as_text``, text without the characters that a removal cut through.

    Columns to ``carry`` follow under their own names.

    A text counts as its UTF-8 bytes, null as empty. A byte is removed if a string of ``length``
    bytes that covers it also starts in a document with a smaller identifier; strings are judged
    on the input, overlaps count, no string crosses documents. ``n_spans`` counts the maximal
    removed runs. Texts shorter than ``length`` stay whole. Rows with equal identifiers are no
    smaller than each other; a null identifier is greater than all others. Identifiers are
    integers. An empty table gives no rows. A group of documents (1 / (3 x shuffle partitions) of
    the table) is a task's work; the longest text counts whole, with some 30 bytes per byte.

    Documents cross the network once; the passes over them share that exchange. Anchors go to
    their blocks packed, strings of repeated anchors as pieces, and what comes back are spans.
    """
    if length < LEAST_ANCHOR + 8:
        raise ValueError(f"strings need {LEAST_ANCHOR + 8} bytes at least")
    width = min(max(length // 2, LEAST_ANCHOR), ANCHOR)
    spark = docs.sparkSession
    groups, blocks = 3 * partitions(spark), partitions(spark)
    share = COMMON_PARTITIONS / partitions(spark)
    kept_kind = pa.string() if as_text else pa.binary()
    size_kind = np.uint8 if 2 * length < 256 else np.int32  # a piece has less than two lengths
    also = {f"c{i}": c for i, c in enumerate(carry)}
    columns = [F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")]
    dealt = grouped(docs.select(*columns, *[F.col(c).alias(k) for k, c in also.items()]), "doc", groups)

    def anchors(group: pa.Table) -> pa.Table:
        ids, grp = _ids(group), group["grp"][0].as_py()
        found, owner = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for first, text, offsets in text_runs(group["text"]):
            _, keys, pick, whole = _anchored(text, offsets, length, width)
            at = pick[whole]
            at = at[_heads(at)] if len(at) else at
            found.append(keys[at])
            owner.append(ids[first + np.searchsorted(offsets, at, "right") - 1])
        keys, owner = np.concatenate(found), np.concatenate(owner)
        order = np.lexsort((owner, keys))
        keys, owner = keys[order], owner[order]
        rows = []
        if len(keys):
            new = np.ones(len(keys), np.int64)  # the first of a document with the anchor
            new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
            head = _heads(keys)
            count = np.add.reduceat(new, head)
            keys = keys[head]
            for block, at in _by_block(_block_of(keys, blocks)):
                more = at[count[at] > 1]
                counts = np.minimum(count[more], 65_535).astype(np.uint16)
                packed = (_low(keys[at]), _low(keys[more]), counts)
                rows.append((block, grp, *(x.tobytes() for x in packed), len(ids)))
        return _rows(_KEYS_ARROW, rows)

    def seen(cell: pa.Table) -> pa.Table:
        packed = [np.frombuffer(x, np.uint32) for x in cell["keys"].to_pylist()]
        keys, place, count = np.unique(np.concatenate(packed), return_inverse=True, return_counts=True)
        more = np.searchsorted(keys, unpacked(cell["more"], np.uint32))
        np.add.at(count, more, unpacked(cell["counts"], np.uint16).astype(np.int64) - 1)
        count = count[place]
        common_at = max(COMMON_ROWS, share * sum(cell["n_docs"].to_pylist()))
        bounds = np.cumsum([0, *map(len, packed)])
        rows = []
        for grp, own, a, b in zip(cell["grp"].to_pylist(), packed, bounds[:-1], bounds[1:], strict=True):
            hits = (np.unique(own[count[a:b] > least]).tobytes() for least in (1, common_at))
            rows.append((grp, _SEEN, *hits, b"", b"", b""))
        return _rows(_REPLY_ARROW, rows)

    def pieces(group: pa.Table, reply: pa.Table) -> pa.Table:
        if not len(reply) or not len(group):
            return _rows(_CELL_ARROW, [])
        group = _ordered(group)
        ids, grp = _ids(group), group["grp"][0].as_py()
        known, common_keys = (np.sort(unpacked(reply[c], np.uint32)) for c in ("keys", "ids"))
        parts: list[tuple] = []
        texts: list[np.ndarray] = []
        runs: list[tuple] = []
        strings, string_ids = [], []
        for first, text, offsets in text_runs(group["text"]):
            sums, key, row, start, end = _runs(text, offsets, length, width)
            if not len(start):
                continue
            common = _in(_low(key), common_keys)
            use = _in(_low(key), known) & ~common
            at, size = start[use], end[use] - start[use]
            run = np.full(len(at), len(texts))
            content = spans(sums, at, at + size)
            parts.append((key[use], content, first + row[use], at - offsets[row[use]], size, run, at))
            texts.append(text)
            if common.any():
                # strings of common anchors: sent by hash, and their places kept for the last pass
                a, n = start[common], end[common] - length + 1 - start[common]
                at = _ranges(a, n)
                strings.append(spans(sums, at, at + length))
                string_ids.append(ids[first + np.repeat(row[common], n)])
                runs.append((first + row[common], a - offsets[row[common]], a - offsets[row[common]] + n))
        cells: dict[int, list[bytes]] = {}
        if parts:
            key, content, row, start, size, run, place = (np.concatenate(x) for x in zip(*parts, strict=True))
            # a content is sent once for all its occurrences in the group
            _, sample, same = np.unique(content, return_index=True, return_inverse=True)
            by_content = np.argsort(same, kind="stable")
            many = np.bincount(same, minlength=len(sample))
            begun = np.cumsum(many) - many
            for block, at in _by_block(_block_of(key[sample], blocks)):
                piece = sample[at]
                pieces_text = np.empty(int(size[piece].sum()), np.uint8)
                where = np.repeat(run[piece], size[piece])
                for r in np.unique(run[piece]).tolist():
                    own = piece[run[piece] == r]
                    pieces_text[where == r] = _gather(texts[r], place[own], size[own])
                occurrence = by_content[_ranges(begun[at], many[at])]
                packed = (
                    _low(key[piece]),
                    size[piece].astype(size_kind),
                    pieces_text,
                    many[at].astype(np.int32),
                    ids[row[occurrence]],
                    row[occurrence].astype(np.int32),
                    start[occurrence].astype(np.int32),
                )
                cells[block] = [_squeezed(x) if x is pieces_text else x.tobytes() for x in packed]
        if strings:
            key, who = np.concatenate(strings), np.concatenate(string_ids)
            order = np.lexsort((who, key))
            order = order[_heads(key[order])]
            key, who = key[order], who[order]
            for block, at in _by_block(_block_of(key, blocks)):
                cells[block] = cells.get(block, [b""] * 7) + [key[at].tobytes(), who[at].tobytes()]
            row, start, end = (np.concatenate(x).astype(np.int32).tobytes() for x in zip(*runs, strict=True))
            cells[-1 - grp] = [end, b"", b"", b"", b"", row, start]
        rows = [(block, grp, *x, *[b""] * (len(_PARTS) - len(x))) for block, x in cells.items()]
        return _rows(_CELL_ARROW, rows)

    def judged(cell: pa.Table) -> pa.Table:
        if cell["block"][0].as_py() < 0:  # a group's own note on its common strings
            out = cell.select(["grp", "rows", "starts", "keys"]).to_pylist()
            return _rows(_REPLY_ARROW, [(x["grp"], _OWN, x["rows"], x["starts"], x["keys"], b"", b"") for x in out])
        packed = [np.frombuffer(x, np.uint64) for x in cell["strings"].to_pylist()]
        distinct, place = np.unique(np.concatenate(packed), return_inverse=True)
        lowest = np.full(len(distinct), _LAST)
        np.minimum.at(lowest, place, unpacked(cell["string_ids"], np.int64))
        lowest = lowest[place]
        bounds = np.cumsum([0, *map(len, packed)])
        counts = [len(x) // 4 for x in cell["rows"].to_pylist()]
        row = unpacked(cell["rows"], np.int32)
        piece, start, end = _piece_spans(
            unpacked(cell["keys"], np.uint32),
            unpacked(cell["sizes"], size_kind).astype(np.int64),
            _spread(cell["text"]),
            unpacked(cell["many"], np.int32),
            unpacked(cell["ids"], np.int64),
            unpacked(cell["starts"], np.int32).astype(np.int64),
            length,
        )
        order = np.argsort(piece, kind="stable")
        piece, start, end = piece[order], start[order], end[order]
        cut = np.searchsorted(piece, np.cumsum([0, *counts]))
        rows = []
        for i, grp in enumerate(cell["grp"].to_pylist()):
            own, text = slice(cut[i], cut[i + 1]), slice(bounds[i], bounds[i + 1])
            spans_ = (row[piece[own]], start[own].astype(np.int32), end[own].astype(np.int32))
            if len(spans_[0]) or len(packed[i]):
                rows.append((grp, _SPAN, *(x.tobytes() for x in (*spans_, packed[i], lowest[text]))))
        return _rows(_REPLY_ARROW, rows)

    def assembled(group: pa.Table, reply: pa.Table) -> pa.Table:
        group = _ordered(group)
        ids = _ids(group)
        kinds = reply["kind"].to_numpy()
        of = {k: reply.filter(pa.array(kinds == k)) for k in (_SPAN, _OWN)}
        row = unpacked(of[_SPAN]["keys"], np.int32)
        start, end = unpacked(of[_SPAN]["ids"], np.int32), unpacked(of[_SPAN]["ends"], np.int32)
        order = np.argsort(row, kind="stable")
        row, start, end = row[order], start[order].astype(np.int64), end[order].astype(np.int64)
        own = np.stack([unpacked(of[_OWN][c], np.int32) for c in ("keys", "ids", "ends")]).astype(np.int64)
        own = own[:, np.argsort(own[0], kind="stable")]
        key, lowest = unpacked(of[_SPAN]["strings"], np.uint64), unpacked(of[_SPAN]["least"], np.int64)
        order = np.argsort(key, kind="stable")
        key, lowest = key[order], lowest[order]
        n_bytes, n_removed, n_spans, kept = [], [], [], []
        for first, text, offsets in text_runs(group["text"]):
            sums = prefix(byte_values(text)) if own.size else None
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                u, v = np.searchsorted(row, [first + i, first + i + 1])
                begin, finish = start[u:v], end[u:v]
                c, d = np.searchsorted(own[0], [first + i, first + i + 1])
                if c < d:
                    n = own[2, c:d] - own[1, c:d]
                    at = _ranges(a + own[1, c:d], n)
                    hashed = spans(sums, at, at + length)
                    hit = at[lowest[np.searchsorted(key, hashed)] < ids[first + i]] - a
                    begin, finish = np.r_[begin, hit], np.r_[finish, hit + length]
                data = text[a:b]
                removed = spans_ = 0
                if len(begin):
                    gone = covered(begin, finish, b - a)
                    removed = int(gone.sum())
                    spans_ = int((gone[1:] & ~gone[:-1]).sum()) + int(gone[0])
                    data = data[~gone]
                n_bytes.append(b - a)
                n_removed.append(removed)
                n_spans.append(spans_)
                data = data.tobytes()
                kept.append(data.decode("utf-8", "ignore") if as_text else data)
        columns = [pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)]
        return pa.table(
            [group["doc"], *columns, pa.array(kept, kept_kind), *[group[k] for k in also]],
            names=["doc", "n_bytes", "n_removed", "n_spans", "kept", *also],
        )

    by_group = dealt.groupBy("grp")
    cells = by_group.applyInArrow(anchors, _KEYS)
    near = cells.groupBy("block").applyInArrow(seen, _REPLY)
    cut = by_group.cogroup(near.groupBy("grp")).applyInArrow(pieces, _CELL)
    verdicts = cut.groupBy("block").applyInArrow(judged, _REPLY)
    schema = f"doc long, n_bytes long, n_removed long, n_spans long, kept {'string' if as_text else 'binary'}"
    schema += "".join(f", {k} {docs.schema[c].dataType.simpleString()}" for k, c in also.items())
    out = by_group.cogroup(verdicts.groupBy("grp")).applyInArrow(assembled, schema)
    return out.select(
        F.col("doc").alias(id_col),
        "n_bytes",
        "n_removed",
        "n_spans",
        "kept",
        *[F.col(k).alias(c) for k, c in also.items()],
    )

