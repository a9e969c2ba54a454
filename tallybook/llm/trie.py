"""The trie of conversation prefixes, by a skeleton of splitters.

A conversation is the path of its turns; two turns are the same node's if role and text are equal.
Paths are compared by digests of their turns (128 bits of SHA-256), so texts are read once and
never shuffled. They are cut into segments of ``SEGMENT`` turns: a segment's root is the digest of
all turns before it, so a row has a bounded size and a conversation of any length is many rows.

Segments are range-partitioned by (root, path, conversation). The splitters' paths, each cut to the
turns that tell its neighbours apart, form the skeleton: a node that is a prefix of a splitter may
lie in several shards, any other lies in one. Every task has the splitters. A shard goes over its
segments in order and finishes all nodes outside the skeleton, with their subtrees. Of skeleton
nodes, and of nodes above a segment that goes on, it gives partial aggregates, which are reduced by
node; then subtree sums climb the few open nodes in steps of 1, 2, 4 ... levels.
"""

from __future__ import annotations

import hashlib
import struct
from bisect import bisect_right
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.common import BREAK_CLASS, partitions, written

# Turns of a segment; bounds a row (24 bytes a turn) and a splitter (16 bytes a turn).
SEGMENT = 1024
# Segments of a shard, and bytes of their paths.
SHARD_ROWS = 40_000
SHARD_BYTES = 6 << 20
# Segments of a shard where there are too few to fill one per partition.
LEAST_ROWS = 256
# Sampled segments per shard, from which the splitters are taken.
SAMPLED = 40
# Turns whose numbers agree but for these low bits are counted together to get their places.
STRETCH_BITS = 10
# Identifiers in one piece of a list of members.
PIECE = 4096

WIDTH = 16
HEADS_FROM = 20


def digest(data: bytes) -> bytes:
    return hashlib.sha256(data).digest()[:WIDTH]


ROOT = digest(b"")


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, turn_digest, n_words), places from 0 in the order of turns, null first.

    Turns of one number are ordered by their digests. A busy conversation's rows are numbered
    within stretches of turn numbers, and the stretches by their counts.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    told = F.concat_ws(":", F.octet_length(role).cast("string"), role, text)
    words = F.filter(F.split(text, BREAK_CLASS), lambda x: x != F.lit(""))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.substring(F.unhex(F.sha2(told, 256)), 1, WIDTH).alias("turn_digest"),
        F.size(words).cast("long").alias("n_words"),
    )
    stretch = F.coalesce(F.shiftright("turn", STRETCH_BITS), F.lit(-(1 << 62)).cast("long"))
    turns = turns.withColumn("stretch", stretch)
    within = Window.partitionBy("conv_id", "stretch").orderBy(F.col("turn").asc_nulls_first(), "turn_digest")
    before = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    counts = turns.groupBy("conv_id", "stretch").count()
    offsets = counts.withColumn("offset", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    return (
        turns.withColumn("nth", F.row_number().over(within))
        .join(offsets, ["conv_id", "stretch"])
        .select("conv_id", (F.col("offset") + F.col("nth") - 1).alias("place"), "turn_digest", "n_words")
    )


def rebuilt(turns: DataFrame) -> DataFrame:
    """Turns of the rebuilt conversations, and a row with a null place for each conversation.

    The first h turns of conversation c - c % 20, then the own ones after the first h, where h is
    crc32 of c in decimal, modulo 4. A base conversation has at most 39 takers, so its few first
    turns go to them by an ordinary join.
    """
    heads = turns.filter((F.col("conv_id") % HEADS_FROM == 0) & (F.col("place") < 3))
    heads = heads.groupBy(F.col("conv_id").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("place", "turn_digest", "n_words"))).alias("head")
    )
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    own = turns.groupBy("conv_id").agg(F.lit(True).alias("seen")).select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % HEADS_FROM).alias("base"), h.alias("h")
    )
    taken = F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), 1, F.col("h").cast("int"))
    plan = own.join(heads, "base", "left").select("conv_id", "h", taken.alias("head"))
    nothing = F.struct(
        F.lit(None).cast("long").alias("place"), F.lit(None).cast("binary").alias("turn_digest"), F.lit(0).cast("long").alias("n_words")
    )
    lent = plan.select("conv_id", F.inline(F.concat("head", F.array(nothing))))
    rest = turns.join(plan.select("conv_id", "h", F.size("head").alias("n_head")), "conv_id").filter("place >= h")
    moved = (F.col("place") - F.col("h") + F.col("n_head")).alias("place")
    return lent.unionByName(rest.select("conv_id", moved, "turn_digest", "n_words"))


def segments(turns: DataFrame, length: int = SEGMENT) -> DataFrame:
    """(conv_id, base, root, path, words, last): each conversation's path in segments.

    ``base`` is the number of turns before, ``root`` their digest, ``path`` the digests of the
    segment's turns, ``last`` whether the conversation ends here. Longer conversations first
    give a digest per segment, and the roots follow from those.
    """
    placed = turns.withColumn("seg", F.floor(F.coalesce("place", F.lit(0)) / length))
    item = F.when(F.col("place").isNotNull(), F.struct("place", "turn_digest", "n_words"))
    parts = placed.groupBy("conv_id", "seg").agg(F.array_sort(F.collect_list(item)).alias("t"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, words = [], []
            for own in batch.column(2).to_pylist():
                paths.append(b"".join(t["turn_digest"] for t in own))
                words.append(struct.pack(f"<{len(own)}q", *[t["n_words"] for t in own]))
            columns = [batch.column(0), batch.column(1), pa.array(paths, pa.binary()), pa.array(words, pa.binary())]
            yield pa.record_batch(columns, ["conv_id", "seg", "path", "words"])

    packed = written(parts.mapInArrow(pack, "conv_id long, seg long, path binary, words binary"), "segments")
    ends = packed.groupBy("conv_id").agg(F.max("seg").alias("last_seg"))
    longer = packed.join(ends.filter("last_seg > 0"), "conv_id").select(
        "conv_id", "seg", F.unhex(F.sha2("path", 256)).alias("of_segment")
    )

    def chain(own: pa.Table) -> pa.Table:
        own = own.sort_by("seg")
        roots, so_far = [], ROOT
        for one in own["of_segment"].to_pylist():
            roots.append(so_far)
            so_far = digest(so_far + one)
        return pa.table([own["conv_id"], own["seg"], pa.array(roots, pa.binary())], names=["conv_id", "seg", "root"])

    roots = longer.groupBy("conv_id").applyInArrow(chain, "conv_id long, seg long, root binary")
    return packed.join(ends, "conv_id").join(roots, ["conv_id", "seg"], "left").select(
        "conv_id",
        (F.col("seg") * length).alias("base"),
        F.coalesce("root", F.lit(ROOT)).alias("root"),
        "path",
        "words",
        (F.col("seg") == F.col("last_seg")).alias("last"),
    )


# (root, path, conversation or None): rows from it on belong to the next shard.
Splitter = tuple[bytes, bytes, int | None]


def _key(root: bytes, path: bytes, conv: int | None) -> tuple:
    return root, path, -(1 << 63) - 1 if conv is None else conv


def splitters(rows: DataFrame, shards: int) -> list[Splitter]:
    """Cuts that part the rows evenly, from some ``SAMPLED`` rows per shard.

    A cut keeps no more turns than tell it from the row before it in the sample, and the
    conversation only between equal paths. At most ``shards`` - 1 cuts of ``SEGMENT`` turns reach
    the driver; the sample itself is cut by a window over its own few rows.
    """
    if shards < 2:
        return []
    total = rows.count()
    share = min(1.0, SAMPLED * shards / max(total, 1))
    picked = rows.filter(F.pmod(F.xxhash64("conv_id", "base"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    order = Window.orderBy("root", "path", "conv_id")
    cost = F.octet_length("path") + F.lit(64)
    up_to = F.sum(cost).over(order)
    whole = F.sum(cost).over(Window.partitionBy())
    shard = F.floor((up_to - cost) * shards / whole)
    marked = picked.select(
        "root", "path", "conv_id", shard.alias("shard"), *[F.lag(c).over(order).alias(f"_{c}") for c in ("root", "path", "conv_id")]
    ).withColumn("_shard", F.lag("shard").over(Window.orderBy("root", "path", "conv_id")))
    cuts = []
    for r in marked.filter("shard <> _shard").orderBy("root", "path", "conv_id").collect():
        path, before = bytes(r["path"]), bytes(r["_path"])
        if r["root"] != r["_root"]:
            cuts.append((bytes(r["root"]), b"", None))
        elif path == before:
            cuts.append((bytes(r["root"]), path, r["conv_id"]))
        else:
            cuts.append((bytes(r["root"]), path[: (_common(path, before) + 1) * WIDTH], None))
    return sorted(set(cuts), key=lambda c: _key(*c))


def _common(a: bytes, b: bytes) -> int:
    """Turns that two paths share at their start."""
    n = min(len(a), len(b)) // WIDTH
    if a[: n * WIDTH] == b[: n * WIDTH]:
        return n
    low, high = 0, n
    while low < high:
        middle = (low + high + 1) // 2
        if a[: middle * WIDTH] == b[: middle * WIDTH]:
            low = middle
        else:
            high = middle - 1
    return low


def _sharded(rows: DataFrame, cuts: Sequence[Splitter]) -> DataFrame:
    keys = [_key(*c) for c in cuts]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ("root", "path", "conv_id")
            columns = zip(*[batch.column(n).to_pylist() for n in names], strict=True)
            shard = [bisect_right(keys, key) for key in columns]
            yield batch.append_column("shard", pa.array(shard, pa.int32()))

    kinds = "conv_id long, base long, root binary, path binary, words binary, last boolean, shard int"
    return rows.mapInArrow(place, kinds)


class _Node:
    __slots__ = ("depth", "n_words", "low", "n", "kids", "leaves", "saved", "ends", "rows", "open")

    def __init__(self, depth: int, n_words: int):
        self.depth, self.n_words = depth, n_words
        self.low: int | None = None
        self.n = self.kids = self.leaves = self.saved = 0
        self.ends: list[int] = []
        self.rows: list[dict] = []
        self.open = False


_NODE = "conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long"
_SHARD = (
    f"kind int, node binary, parent binary, n_words long, shard int, piece int, ends string, {_NODE}, "
    "parent_conv_id long, ends_sha256 string"
)
_SHARD_ARROW = pa.schema(
    [
        ("kind", pa.int32()),
        ("node", pa.binary()),
        ("parent", pa.binary()),
        ("n_words", pa.int64()),
        ("shard", pa.int32()),
        ("piece", pa.int32()),
        ("ends", pa.string()),
        *[(c, pa.int64()) for c in ("conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens")],
        ("parent_conv_id", pa.int64()),
        ("ends_sha256", pa.string()),
    ]
)
# Kinds of rows that a shard gives: finished nodes, partial aggregates, pieces of member lists.
DONE, PARTIAL, MEMBERS = 0, 1, 2


def _finish(cuts: Sequence[Splitter], length: int):
    """The work on one shard, as a function of its rows."""

    def finish(shard_rows: pa.Table) -> pa.Table:
        shard = shard_rows["shard"][0].as_py()
        names = ("root", "path", "conv_id", "base", "words", "last")
        rows = sorted(zip(*[shard_rows[n].to_pylist() for n in names], strict=True))
        near = [cuts[i] for i in (shard - 1, shard) if 0 <= i < len(cuts)]
        out: list[dict] = []
        stack: list[_Node] = []
        root, path = b"", b""
        skeleton = -1  # nodes of the path up to this depth are prefixes of a splitter

        def node_id(depth: int) -> bytes:
            if not depth:
                return root
            whole = path[: depth * WIDTH]
            # a whole segment is the next one's root
            return digest(root + hashlib.sha256(whole).digest()) if depth == length else digest(b"n" + root + whole)

        def close() -> None:
            node = stack.pop()
            above = stack[-1] if stack else None
            depth = len(stack)
            if node.open or depth <= skeleton or not depth:
                name = node_id(depth)
                parent = node_id(depth - 1) if depth else None
                inner = not depth and root != ROOT  # its own shard tells of it; here only what is below
                out.append(
                    {
                        "kind": PARTIAL, "node": name, "parent": parent,
                        "n_words": None if inner else node.n_words,
                        "conv_id": None if inner else node.low,
                        "depth": None if inner else node.depth,
                        "n_convs": 0 if inner else node.n,
                        "n_children": node.kids, "n_leaves": node.leaves, "saved_tokens": node.saved,
                    }
                )
                for at in range(0, len(node.ends), PIECE):
                    told = ",".join(map(str, node.ends[at : at + PIECE]))
                    out.append({"kind": MEMBERS, "node": name, "shard": shard, "piece": at // PIECE, "ends": told})
                for row in node.rows:
                    row["parent"] = name
                if above:
                    above.open = True
            else:
                node.leaves = node.leaves if node.kids else 1
                node.saved += (node.n - 1) * node.n_words
                row = {
                    "kind": DONE, "conv_id": node.low, "depth": node.depth, "n_convs": node.n,
                    "n_children": node.kids, "n_leaves": node.leaves, "saved_tokens": node.saved,
                    "ends_sha256": hashlib.sha256(",".join(map(str, node.ends)).encode()).hexdigest(),
                }
                out.append(row)
                for below in node.rows:
                    below["parent_conv_id"] = node.low
                above.rows.append(row)
                above.kids += 1
                above.leaves += node.leaves
                above.saved += node.saved
            if above:
                above.n += node.n
                above.low = node.low if above.low is None else min(above.low, node.low)

        for own_root, own_path, conv, base, words, last in rows:
            shared = _common(path, own_path) if stack and own_root == root else -1
            while len(stack) > shared + 1:
                close()
            root, path = own_root, own_path
            skeleton = max([_common(p, path) for r, p, _ in near if r == root], default=-1)
            depth = len(path) // WIDTH
            counts = struct.unpack(f"<{depth}q", words)
            for d in range(len(stack), depth + 1):
                stack.append(_Node(base + d, counts[d - 1] if d else 0))
            top = stack[-1]
            top.n += 1
            top.low = conv if top.low is None else min(top.low, conv)
            if last:
                top.ends.append(conv)
            else:
                top.open = True
        while stack:
            close()
        columns = [[row.get(name) for row in out] for name in _SHARD_ARROW.names]
        return pa.table([pa.array(c, t) for c, t in zip(columns, _SHARD_ARROW.types, strict=True)], schema=_SHARD_ARROW)

    return finish


def _member_digests(pieces: DataFrame, count: int) -> DataFrame:
    """(node, ends_sha256): SHA-256 of each node's members, read piece by piece in order.

    The digest is of one long text, so one task reads the numbers of a node's members, and no
    more than one batch of pieces is held.
    """

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, so_far = None, None
        done: list[tuple[bytes, str]] = []
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if name == node:
                    so_far.update(b"," + text.encode())
                    continue
                if node is not None:
                    done.append((node, so_far.hexdigest()))
                node, so_far = name, hashlib.sha256(text.encode())
            if len(done) > 4096:
                yield _pairs(done)
                done = []
        if node is not None:
            done.append((node, so_far.hexdigest()))
        yield _pairs(done)

    in_order = pieces.repartition(count, "node").sortWithinPartitions("node", "shard", "piece").select("node", "ends")
    return in_order.mapInArrow(told, "node binary, ends_sha256 string")


def _pairs(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array([a for a, _ in rows], pa.binary()), pa.array([b for _, b in rows], pa.string())], ["node", "ends_sha256"]
    )


def _climbed(nodes: DataFrame) -> DataFrame:
    """Open nodes with the leaves and tokens of their whole subtrees.

    Each node starts with its own share and a pointer to its parent. A step adds to every node what
    points at it and doubles all pointers' reach, so that depth d takes log2(d) steps.
    """
    state = nodes.select("node", F.col("parent").alias("up"), "n_leaves", "saved_tokens")
    depth = nodes.agg(F.max("depth")).first()[0] or 0
    for _ in range(int(depth).bit_length()):
        climbing = state.filter("up is not null")
        given = climbing.groupBy(F.col("up").alias("node")).agg(
            F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved")
        )
        reach = climbing.select("node", "up").join(
            climbing.select(F.col("node").alias("up"), F.col("up").alias("further")), "up", "left"
        )
        added = state.drop("up").join(given, "node", "left").join(reach.select("node", "further"), "node", "left")
        state = written(
            added.select(
                "node",
                F.col("further").alias("up"),
                (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
                (F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
            ),
            "climbed",
        )
    return state.drop("up")


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def nodes_of(rows: DataFrame, length: int = SEGMENT) -> DataFrame:
    """One row per node of the trie of ``segments``."""
    spark = rows.sparkSession
    rows = written(rows, "paths")
    cost = F.octet_length("path") * 3 / 2 + 64
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(cost), F.lit(0.0)).alias("bytes")).first()
    few = min(partitions(spark), size["n"] // LEAST_ROWS + 1)
    shards = max(few, -(-size["n"] // SHARD_ROWS), int(size["bytes"] // SHARD_BYTES) + 1)
    cuts = splitters(rows, shards)
    found = written(_sharded(rows, cuts).groupBy("shard").applyInArrow(_finish(cuts, length), _SHARD), "nodes")

    partial = found.filter(F.col("kind") == PARTIAL)
    kids = partial.filter("parent is not null").select("node", "parent").distinct()
    kids = kids.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("open_kids"))
    reduced = partial.groupBy("node").agg(
        F.max("parent").alias("parent"),
        *[F.max(c).alias(c) for c in ("n_words", "depth")],
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    members = _member_digests(found.filter(F.col("kind") == MEMBERS), partitions(spark))
    children = F.col("n_children") + F.coalesce("open_kids", F.lit(0))
    whole = reduced.join(kids, "node", "left").join(members, "node", "left").select(
        "node",
        "parent",
        "conv_id",
        "depth",
        "n_convs",
        children.alias("n_children"),
        (F.col("n_leaves") + (children == 0).cast("long")).alias("n_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("n_words")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
    whole = written(whole, "open")
    named = whole.select(F.col("node").alias("parent"), F.col("conv_id").alias("of_parent"))
    opened = whole.drop("n_leaves", "saved_tokens").join(_climbed(whole), "node").join(named, "parent", "left")
    opened = opened.withColumn("parent_conv_id", F.col("of_parent"))
    done = found.filter(F.col("kind") == DONE).join(named, "parent", "left")
    done = done.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "of_parent"))
    return done.select(*COLUMNS).unionByName(opened.select(*COLUMNS))


def prefix_trie(conversations: DataFrame, borrow_heads: bool = False, length: int = SEGMENT) -> DataFrame:
    """One row per distinct sequence of first turns of conversations, a node of their trie.

    conv_id is the smallest member; depth; parent_conv_id, the parent's conv_id (null at the root);
    n_convs, the members; n_children; n_leaves, childless nodes in the subtree, itself included;
    saved_tokens, over the subtree the words of each node's last text times its members less one;
    ends_sha256, the SHA-256 of the numbers of members that end here, ascending and joined by
    commas. With ``borrow_heads`` conversations are first rebuilt, see ``rebuilt``.

    Turns are ordered by number, null first, those of one number by digest; repeated rows are turns
    of their own. A null role or text is empty. Rows with a null conv_id take no part; an empty
    table has no node, not even a root. A conversation without turns is a member of the root.
    Columns other than conv_id, turn, role and text play no part, whatever their names. Texts of
    any length are hashed whole and conversations of any length are cut into segments.
    """
    turns = turn_rows(conversations)
    if borrow_heads:
        turns = rebuilt(written(turns, "turns"))
    return nodes_of(segments(turns, length), length)
