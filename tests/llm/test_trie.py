import hashlib
import random
import re
import zlib

import pytest

from tallybook.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def of_turn(role, text):
    role, text = role or "", text or ""
    told = f"{len(role.encode())}:{role}:{text}".encode()
    return hashlib.sha256(told).digest()[:16], len(WORD.findall(text))


def brute(rows, borrow):
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, *of_turn(role, text)))
    paths = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    if borrow:
        h = {c: zlib.crc32(str(c).encode()) % 4 for c in paths}
        base = {c: c - (c % 20 if c >= 0 else -(-c % 20)) for c in paths}
        paths = {c: paths.get(base[c], [])[: h[c]] + p[h[c] :] for c, p in paths.items()}
    nodes = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            node = nodes.setdefault(tuple(path[:d]), {"members": [], "ends": [], "kids": set()})
            node["members"].append(c)
            if d == len(path):
                node["ends"].append(c)
            else:
                node["kids"].add(path[d])
    out = []
    for key in nodes:
        below = [k for k in nodes if k[: len(key)] == key]
        saved = sum((len(nodes[k]["members"]) - 1) * k[-1][1] for k in below if k)
        out.append(
            (
                min(nodes[key]["members"]),
                len(key),
                min(nodes[key[:-1]]["members"]) if key else None,
                len(nodes[key]["members"]),
                len(nodes[key]["kids"]),
                sum(not nodes[k]["kids"] for k in below),
                saved,
                hashlib.sha256(",".join(map(str, sorted(nodes[key]["ends"]))).encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r[c] for c in trie.COLUMNS) for r in df.collect()), key=repr)


def conversations(seed=3, n=120):
    """Few different turns, so that prefixes meet; copies, a hot opening, null and equal turns."""
    draw = random.Random(seed)
    rows = []
    for c in range(-25, n):
        kind = draw.randrange(4)
        length = draw.choice([1, 2, 3, 5, 9])
        for t in range(length):
            text = "hot opening here" if t == 0 and kind else f"say {draw.randrange(3)} " * (t % 3)
            rows.append((c, t, draw.choice(["user", "user", "bot"]) if t else "user", text))
    for c in range(n, n + 60):  # copies of one conversation
        rows += [(c, t, "user", f"same {t}") for t in range(4)]
    rows += [(500, None, "user", "first"), (500, None, None, None), (500, 3, "user", ""), (500, 3, "bot", "tie"), (500, 3, "user", "")]
    rows += [(None, 0, "user", "no conversation"), (501, 7, "", "")]
    return rows


@pytest.mark.parametrize(
    "shard_rows,length,borrow", [(10**6, 1024, True), (15, 1024, False), (15, 2, True), (4, 3, True), (1, 1, False)]
)
def test_against_brute_force(spark, monkeypatch, shard_rows, length, borrow):
    """From one shard to one per row, and segments down to a single turn."""
    monkeypatch.setattr(trie, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(trie, "PIECE", 3)
    n = 120 if shard_rows > 4 else 30
    rows = conversations(n=n)
    got = found(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), borrow, length))
    assert got == brute(rows, borrow)


def test_long_conversations_and_busy_ones(spark, monkeypatch):
    """Turns over many stretches, in any order; one conversation has most rows."""
    monkeypatch.setattr(trie, "SHARD_ROWS", 3)
    draw = random.Random(1)
    rows = [(1, t * 700 - 10_000, "user", f"t{t} and more") for t in range(60)]
    rows += [(2, t, "user", f"t{t} and more") for t in range(40)]
    rows += [(c, t, "user", f"t{t} and more") for c in (3, 4, 5) for t in range(c)]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    for length in (7, 64):
        assert found(trie.prefix_trie(df, length=length)) == brute(rows, False)


def test_empty_turnless_and_clashing_columns(spark):
    schema = SCHEMA + ", place int, node string, depth int, seg int"
    assert trie.prefix_trie(spark.createDataFrame([], schema)).count() == 0
    nothing = [(None, 1, "user", "x", 1, "n", 2, 3)]
    assert trie.prefix_trie(spark.createDataFrame(nothing, schema), True).count() == 0
    # one turn, all of which goes to a base conversation that is absent
    conv = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)
    rows = [(conv, 0, "user", "x", 1, "n", 2, 3)]
    got = found(trie.prefix_trie(spark.createDataFrame(rows, schema), True))
    assert got == brute(rows, True) and len(got) == 1 and got[0][2] is None


def test_very_long_text_and_role(spark):
    rows = [(1, 0, "r" * 100_000, "word " * 400_000), (2, 0, "r" * 100_000, "word " * 400_000), (3, 0, "r", "word")]
    assert found(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows, False)


def test_role_and_text_do_not_run_together(spark):
    rows = [(1, 0, "a:b", "c"), (2, 0, "a", "b:c"), (3, 0, "", "1:a:c"), (4, 0, None, "1:a:c")]
    got = found(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA)))
    assert len(got) == 4 and got == brute(rows, False)


def test_skeleton_is_small(spark, monkeypatch):
    """A node is reduced over shards only if a splitter starts with it."""
    rows = [(c, t, "user", f"{c if t else 0} {t}") for c in range(400) for t in range(6)]
    monkeypatch.setattr(trie, "SHARD_ROWS", 50)
    paths = trie.segments(trie.turn_rows(spark.createDataFrame(rows, SCHEMA)))
    cuts = trie.splitters(paths, 8)
    assert 4 <= len(cuts) <= 7
    assert all(len(path) <= 2 * trie.WIDTH for _, path, _ in cuts)  # the hot opening and one turn
