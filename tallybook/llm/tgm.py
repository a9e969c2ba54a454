"""N-gram Jaccard join by a token-group matrix.

A document's set holds its distinct word shingles. Similar sets are put into groups. The matrix has a row for each token and group whose union
holds it, and a query meets only the groups that share a token with it which a partner must
share. Within such a group the query's overlap with the group's token union bounds its overlap
with every member, and only a group that passes the bound is opened and its members compared.

A group holds sets that share their first leader, in parts of bounded size, so its token union
stays close to each of them. Three steps keep the matrix small and lose no link. Equal sets are one set. A set of n tokens
needs a partner for all but n / 10 of them, so sets with more tokens that no other set has are
out; that is judged on a quarter of the tokens first, chosen by hash, and then on all. And of a
set's tokens, rarest first, only the first tenth can decide: two linked sets share one of those.

Sets are first compared with leaders alone, one for each token, which links most of what is
linked at all; sets that are known to be connected get one label. What is left to open are
groups with members of other labels than the query's; of two labels the queries are the sets of
the one that fewer have. Leaders and groups with many
visitors are split, so that no task holds more than some hundred sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import (
    CELL,
    cells_table,
    grouped,
    mix,
    pack,
    partitions,
    prefix,
    repeated,
    scratch,
    spans,
    text_runs,
    unpacked,
    up_to_twice,
    windows,
    word_bounds,
    word_keys,
    written,
)
from tallybook.llm.graph import components, labelled

SHINGLE = 3
PERCENT = 90
# Sets that a group holds, and visitors that one task compares with it.
CAPACITY = 64


def _block_of(keys: np.ndarray, blocks: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) % np.uint64(blocks)).astype(np.int32)


def _low(keys: np.ndarray) -> np.ndarray:
    return (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _place(keys: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where keys lie among the known ones, and whether they are among them."""
    if not len(known):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return at, known[at] == keys


def token_sets(text: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> tuple:
    """Tokens of all texts in the order of text and token, each once, and their bounds.

    A-Z count as a-z. A text with fewer words than a shingle has its words as its only token,
    one without words has none.
    """
    low = text + 32 * ((text >= 65) & (text <= 90)).astype(np.uint8)
    starts, ends, bounds = word_bounds(low, offsets)
    sums = prefix(word_keys(low, starts, ends))
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    full = windows(sums, shingle)
    own = owner[: len(full)] == owner[shingle - 1 :] if len(full) else np.zeros(0, bool)
    short = np.flatnonzero((np.diff(bounds) > 0) & (np.diff(bounds) < shingle))
    token = np.r_[full[own], spans(sums, bounds[short], bounds[short + 1])]
    owner = np.r_[owner[: len(full)][own], short]
    order = np.lexsort((token, owner))
    token, owner = token[order], owner[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
    token, owner = token[new], owner[new]
    return token, np.searchsorted(owner, np.arange(len(bounds)))


def _prints(token: np.ndarray, bounds: np.ndarray) -> list[bytes | None]:
    """128 bits for each set, None for an empty one."""
    one = np.r_[np.uint64(0), np.cumsum(mix(token))]
    two = np.r_[np.uint64(0), np.cumsum(mix(token ^ np.uint64(0xA5A5A5A5DEADBEEF)))]
    both = np.stack([one[bounds[1:]] - one[bounds[:-1]], two[bounds[1:]] - two[bounds[:-1]]], 1)
    return [x.tobytes() if n else None for x, n in zip(both, np.diff(bounds).tolist(), strict=True)]


def _spare(n: np.ndarray, percent: int) -> np.ndarray:
    """How many of n tokens a linked set may lack."""
    return n - (n * percent + 99) // 100


def _sampled(token: np.ndarray) -> np.ndarray:
    return (token >> np.uint64(20)) & np.uint64(3) == 0


_SETS = "doc {kind}, n_shingles long, print binary, tokens binary"


def _candidates(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(doc, n_shingles, print, tokens): tokens for sets that may have a link, once in a group."""
    spark = docs.sparkSession
    groups, blocks = 3 * partitions(spark), partitions(spark)
    dealt = grouped(docs, "doc", groups)
    kind = docs.schema["doc"].dataType.simpleString()

    def sample(group: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.uint64)]
        for _, text, offsets in text_runs(group["text"]):
            token, _ = token_sets(text, offsets, shingle)
            found.append(token[_sampled(token)])
        keys = up_to_twice(np.concatenate(found))
        return cells_table(pack(_low(keys), _block_of(keys, blocks), group["grp"][0].as_py(), blocks))

    def judged(group: pa.Table, reply: pa.Table) -> pa.Table:
        known = np.sort(unpacked(reply["keys"], np.uint32))
        sizes, prints, tokens, sent = [], [], [], set()
        for _, text, offsets in text_runs(group["text"]):
            token, bounds = token_sets(text, offsets, shingle)
            chosen = _sampled(token)
            lonely = chosen.copy()
            lonely[chosen] = ~_place(_low(token[chosen]), known)[1]
            alone = np.r_[0, np.cumsum(lonely)]
            n = np.diff(bounds)
            may = (n > 0) & (alone[bounds[1:]] - alone[bounds[:-1]] <= _spare(n, percent))
            sizes.append(n)
            for i, print_ in enumerate(_prints(token, bounds)):
                prints.append(print_)
                send = bool(may[i]) and print_ not in sent
                tokens.append(token[bounds[i] : bounds[i + 1]].tobytes() if send else None)
                if send:
                    sent.add(print_)
        n = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        return pa.table(
            [group["doc"], pa.array(n, pa.int64()), pa.array(prints, pa.binary()), pa.array(tokens, pa.binary())],
            names=["doc", "n_shingles", "print", "tokens"],
        )

    near = repeated(dealt.groupBy("grp").applyInArrow(sample, CELL), np.uint32)
    return dealt.groupBy("grp").cogroup(near.groupBy("grp")).applyInArrow(judged, _SETS.format(kind=kind))


_COUNTED = pa.schema(
    [("grp", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]
)


def _counter(token: np.ndarray, blocks: int) -> np.ndarray:
    """The counter of a token: its block, and 32 bits within it. Tokens that share one are counted
    together, everywhere alike, so that the order by frequency stays one order for all sets."""
    return _block_of(token, blocks).astype(np.uint64) << np.uint64(32) | _low(token)


def _deciding(known: DataFrame, percent: int) -> DataFrame:
    """For each set that may still have a link a row (print, n, tokens) with its tokens, and a row
    (token, print, n) for those of its deciding tokens that another set has. Deciding are the first
    in the order of frequency and hash. Sets cross the network once."""
    spark = known.sparkSession
    groups, blocks = 3 * partitions(spark), partitions(spark)
    sent = grouped(known.filter("tokens is not null").select("print", "tokens"), "print", groups)
    # dealt first, so that equal sets are one without an exchange of their own
    dealt = sent.repartition("grp").groupBy("grp", "print").agg(F.first("tokens").alias("tokens"))

    def counted(group: pa.Table) -> pa.Table:
        token = unpacked(group["tokens"], np.uint64)
        keys, count = np.unique(_counter(token, blocks), return_counts=True)
        where = (keys >> np.uint64(32)).astype(np.int32)
        rows = pack(_low(keys), where, group["grp"][0].as_py(), blocks)
        counts = pack(count.astype(np.int32), where, 0, blocks)
        table = cells_table(rows)
        return table.append_column("counts", pa.array([x[2] for x in counts], pa.binary()))

    def summed(cell: pa.Table) -> pa.Table:
        packed = [np.frombuffer(x, np.uint32) for x in cell["keys"].to_pylist()]
        count = unpacked(cell["counts"], np.int32)
        _, place = np.unique(np.concatenate(packed), return_inverse=True)
        total = np.minimum(np.bincount(place, count), 2**31 - 1).astype(np.int32)[place]
        bounds = np.cumsum([0, *map(len, packed)])
        block, rows = cell["block"][0].as_py(), []
        for grp, keys, a, b in zip(cell["grp"].to_pylist(), packed, bounds[:-1], bounds[1:], strict=True):
            several = total[a:b] > 1
            if several.any():
                rows.append((grp, block, keys[several].tobytes(), total[a:b][several].tobytes()))
        columns = list(zip(*rows, strict=True)) if rows else [()] * 4
        return pa.table([pa.array(c, t) for c, t in zip(columns, _COUNTED.types, strict=True)], _COUNTED)

    def chosen(group: pa.Table, reply: pa.Table) -> pa.Table:
        packed = [np.frombuffer(x, np.uint32) for x in reply["keys"].to_pylist()]
        block = np.repeat(np.array(reply["block"].to_pylist(), np.uint64), [len(x) for x in packed])
        low = np.concatenate([np.zeros(0, np.uint32), *packed])
        keys, count = block << np.uint64(32) | low, unpacked(reply["counts"], np.int32)
        order = np.argsort(keys)
        keys, count = keys[order], count[order]
        token, print_, size, tokens = [], [], [], []
        for name, raw in zip(group["print"].to_pylist(), group["tokens"].to_pylist(), strict=True):
            own = np.frombuffer(raw, np.uint64)
            at, found = _place(_counter(own, blocks), keys)
            often = np.where(found, count[at] if len(count) else 0, 1)
            n = len(own)
            first = np.lexsort((own, often))[: int(_spare(np.int64(n), percent)) + 1]
            first = first[often[first] > 1]
            if len(first):
                token += [None, *own[first].astype(np.int64).tolist()]
                print_ += [name] * (1 + len(first))
                size += [n] * (1 + len(first))
                tokens += [raw] + [None] * len(first)
        return pa.table(
            [
                pa.array(token, pa.int64()),
                pa.array(print_, pa.binary()),
                pa.array(size, pa.int64()),
                pa.array(tokens, pa.binary()),
            ],
            names=["token", "print", "n", "tokens"],
        )

    schema = CELL + ", counts binary"
    often = dealt.groupBy("grp").applyInArrow(counted, schema).groupBy("block")
    replies = often.applyInArrow(summed, "grp int, block int, keys binary, counts binary")
    return dealt.groupBy("grp").cogroup(replies.groupBy("grp")).applyInArrow(
        chosen, "token long, print binary, n long, tokens binary"
    )


def _split(rows: DataFrame, keys: list[str], spread: str, out: str) -> DataFrame:
    """The rows with ``out``: a part of their key's rows, of some CAPACITY rows each."""
    large = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("_many"))
    large = written(large.filter(F.col("_many") > CAPACITY), "large")
    on = [F.col(k) == F.col(f"_{k}") for k in keys]
    parts = F.ceil(F.col("_many") / CAPACITY)
    part = F.when(F.col("_many").isNull(), 0).otherwise(F.pmod(F.xxhash64(F.lit(7), spread), parts))
    joined = rows.join(large, on, "left").withColumn(out, part.cast("int"))
    return joined.select(*rows.columns, out)


def _opened(visits: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between visitors (print, comp, lead, part) and members of the groups they visit.

    One link at most for each visitor and component among a group's members, and none within
    the visitor's own: members of a component are linked already.
    """
    visits = written(_split(visits, ["lead", "part"], "print", "chunk"), "visits")
    chunks = visits.select("lead", "part", "chunk").distinct()
    hosts = members.select("lead", "part", "print", "comp")
    # written, so that Spark knows how few they are before it would shuffle all sets; where it has to,
    # hosts and visitors ask for the sets in the same words and share that exchange
    hosts = written(hosts.join(chunks, ["lead", "part"]), "hosts").join(sets, "print")
    keys = ["lead", "part", "chunk"]
    hosts = hosts.select(*[F.col(c).alias(f"host_{c}") for c in ("print", "comp", "tokens", *keys)])
    guests = visits.join(sets, "print")

    def compared(guest: pa.Table, host: pa.Table) -> pa.Table:
        links: list[tuple[bytes, bytes]] = []
        if len(guest) and len(host):
            names, comps = host["host_print"].to_pylist(), host["host_comp"].to_pylist()
            packed = [np.frombuffer(x, np.uint64) for x in host["host_tokens"].to_pylist()]
            size = np.array([len(x) for x in packed])
            token = np.concatenate(packed)
            owner = np.repeat(np.arange(len(packed)), size)
            order = np.argsort(token, kind="stable")
            token, owner = token[order], owner[order]
            union, begin = np.unique(token, return_index=True)  # the group's token union
            end = np.r_[begin[1:], len(token)]
            columns = [guest[c].to_pylist() for c in ("print", "comp", "tokens")]
            for print_, comp, raw in zip(*columns, strict=True):
                own = np.frombuffer(raw, np.uint64)
                at, found = _place(own, union)
                if 100 * int(found.sum()) < percent * len(own):
                    continue  # no member can share enough
                at = at[found]
                many = end[at] - begin[at]
                flat = np.repeat(begin[at] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
                common = np.bincount(owner[flat], minlength=len(size))
                linked = np.flatnonzero(100 * common >= percent * (len(own) + size - common))
                one_each = {comps[i]: names[i] for i in linked.tolist() if comps[i] != comp}
                links.extend((print_, name) for name in one_each.values())
        a, b = zip(*links, strict=True) if links else ((), ())
        return pa.table([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    by_host = hosts.groupBy(*[f"host_{k}" for k in keys])
    return guests.groupBy(*keys).cogroup(by_host).applyInArrow(compared, "a binary, b binary")


def _sizes_fit(n: str, least: str, most: str, percent: int) -> Column:
    return (100 * F.col(most) >= percent * F.col(n)) & (percent * F.col(least) <= 100 * F.col(n))


def _classes(rows: DataFrame, shingle: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc, n_shingles, print, comp) of every document, and the least document of each comp."""
    known = written(_candidates(rows, shingle, percent), "shingles")
    deciding = written(_deciding(known, percent), "deciding")
    sets = deciding.filter("tokens is not null").select("print", "tokens")
    index = deciding.filter("tokens is null").select("token", "print", "n")

    # leaders: of each token the first set that has it; a set visits its tokens' leaders
    leaders = index.groupBy("token").agg(F.min(F.struct("print", "n")).alias("first"))
    leaders = leaders.select("token", F.col("first.print").alias("lead"), F.col("first.n").alias("lead_n"))
    led = written(index.join(written(leaders, "leaders"), "token"), "led")
    fit = _sizes_fit("n", "lead_n", "lead_n", percent)
    visits = led.filter(fit & (F.col("print") != F.col("lead"))).select(
        "print", F.col("print").alias("comp"), "lead", F.lit(0).alias("part")
    )
    alone = led.select("lead").distinct().select(
        "lead", F.lit(0).alias("part"), F.col("lead").alias("print"), F.col("lead").alias("comp")
    )
    links = written(_opened(visits.distinct(), alone, sets, percent), "links-to-leaders")

    # groups: the sets with the same first leader, in parts, linked with it or not
    placed = led.groupBy("print").agg(F.first("n").alias("n"), F.min("lead").alias("lead"))
    labels = labelled(placed.select(F.col("print").alias("node")), links)
    placed = placed.join(labels.withColumnRenamed("node", "print"), "print")
    weights = placed.groupBy("comp").agg(F.count(F.lit(1)).alias("weight"))
    placed = written(_split(placed.join(weights, "comp"), ["lead"], "print", "part"), "groups")
    top = F.max(F.struct("weight", "comp")).alias("top")
    groups = placed.groupBy("lead", "part").agg(F.min("n").alias("least"), F.max("n").alias("most"), top)
    groups = written(groups, "group-sizes")

    # the matrix: tokens that several components have, and the groups that have them. Tokens
    # of the same groups are one row and column, named by a hash of those groups.
    at = index.select("token", "print").join(placed, "print")
    unsettled = at.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y"))
    unsettled = written(unsettled.filter("x != y").select("token"), "unsettled")
    at = written(at.join(unsettled, "token"), "open")
    cells = at.select("token", "lead", "part").distinct()
    hashed = [F.bit_xor(F.xxhash64(F.lit(i), "lead", "part")) for i in (1, 2)]
    rows_of = cells.groupBy("token").agg(F.struct(*hashed, F.count(F.lit(1))).alias("row"))
    rows_of = written(rows_of, "rows")
    matrix = cells.join(rows_of, "token").select("row", "lead", "part").distinct()
    matrix = written(matrix.join(groups, ["lead", "part"]), "matrix")
    queries = at.join(rows_of, "token").select("row", "print", "n", "comp", "weight").distinct()
    smaller = F.struct("weight", "comp") < F.col("top")
    fit = _sizes_fit("n", "least", "most", percent)
    visits = written(queries, "queries").join(matrix, "row").filter(smaller & fit)
    visits = visits.select("print", "comp", "lead", "part").distinct()
    links = links.unionByName(_opened(visits, placed, sets, percent))
    for end in ("a", "b"):  # links between labels, which are few
        at = labels.select(F.col("node").alias(end), F.col("comp").alias("label"))
        links = links.join(at, end).drop(end).withColumnRenamed("label", end)
    merged = components(links).select(F.col("node").alias("comp"), F.col("comp").alias("whole"))
    comps = labels.join(merged, "comp", "left").select(
        F.col("node").alias("print"), F.coalesce("whole", "comp").alias("comp")
    )

    # from sets back to documents
    named = known.select("doc", "n_shingles", "print").join(comps, "print", "left")
    named = written(named.withColumn("comp", F.coalesce("comp", "print")), "named")
    least = written(named.filter("comp is not null").groupBy("comp").agg(F.min("doc").alias("least")), "least")
    return named, least


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """(id, n_shingles, component_id) of every document.

    Documents are linked if their sets share at least ``percent`` of their union;
    ``component_id`` is the smallest identifier that links reach, the document's own included.
    Null and empty texts, and those without words, have no shingles and no links: they are
    their own components. Rows with equal texts are linked, repeated rows included. Null
    identifiers are passed over as component ids where the component has another.
    """
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    with scratch(docs.sparkSession, keep=("named", "least")):
        named, least = _classes(rows, shingle, percent)
    return named.join(least, "comp", "left").select(
        F.col("doc").alias(id_col), "n_shingles", F.coalesce("least", "doc").alias("component_id")
    )
