"""The stages on a small corpus, each against brute force on its own input."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tallybook.llm import lang, mixing, tokens

from .fixtures import SCHEMA, awkward, frame, sentence
from .test_bwt import brute as shared_brute
from .test_mixing import shares
from .test_tgm import brute as near_brute


def corpus():
    draw = random.Random(12)
    passage = sentence(draw, 60, 5000)
    base = sentence(draw, 150, 5000)
    texts = [sentence(draw, draw.randrange(30, 150), 5000) for _ in range(40)]
    texts += [base] * 3 + [base.replace(base.split()[5], "edited")]
    texts += [f"{sentence(draw, 40, 5000)} {passage} {sentence(draw, 40, 5000)}" for _ in range(6)]
    texts += [None, "", "12 34 !", "é" * 400, "x" + "é" * 399, passage]
    return [(i, t, None if i % 9 == 0 else "en", f"s{i % 4}", len(t or "")) for i, t in enumerate(texts)]


def test_stages(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    by_name = dict(pipeline.STAGES)
    assert list(by_name) == ["language", "near copies", "shared passages", "mix", "pack"]

    def run(name, docs):
        out = pipeline.written(by_name[name](spark, docs, ""), "test-stage")
        if name != "pack":
            assert out.columns == pipeline.COLUMNS
        return out, out.collect()

    docs, got = run("language", docs)
    lettered = {i for i, t, *_ in rows if t and any(c.isalpha() for c in t)}
    assert {r["doc_id"] for r in got} == lettered
    assert all(r["lang"] == "en" for r in got)

    before = [(r["doc_id"], r["text"]) for r in got]
    docs, got = run("near copies", docs)
    assert {r["doc_id"] for r in got} == {c for _, _, c in near_brute(before)}
    assert len(got) == len({r["doc_id"] for r in got}) < len(before)

    before = [(r["doc_id"], r["text"]) for r in got]
    docs, got = run("shared passages", docs)
    expected = {d: kept.decode("utf-8", "ignore") for d, n, gone, _, kept in shared_brute(before, 50) if gone < n or not n}
    assert {r["doc_id"]: r["text"] for r in got} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert expected != dict(before)

    sizes, source = {}, {}
    for r in got:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(r["text"].split())
        source[r["doc_id"]] = r["source"]
    longest = max(len(r["text"].split()) for r in got)
    docs, got = run("mix", docs)
    for name, goal in shares(sizes).items():
        taken = sum(len(r["text"].split()) for r in got if r["source"] == name)
        assert abs(taken - goal) <= longest
    assert max(sum(r["doc_id"] == d for r in got) for d in source) <= 3

    _, placed = run("pack", docs)
    library = tokens.encoder(tokens.vocabulary_path()).library
    lengths = [len(library.encode(r["text"], add_special_tokens=False).ids) + 1 for r in got]
    assert sum(r["length"] for r in placed) == sum(lengths)
    ends = {}
    for r in sorted(placed, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 2048


def edited(text, at):
    own = text.split()
    for i in at:
        own[i] = f"edit{i}"
    return " ".join(own)


def test_near_copies_of_five_words_and_80_percent(spark):
    draw = random.Random(5)
    bases = [sentence(draw, 200, 100_000) for _ in range(12)]
    # 4 scattered edits leave 176 of 216 shingles of five words, 5 leave 171 of 221
    copies = [edited(t, range(20, 20 + 36 * (4 + i % 2), 36)) for i, t in enumerate(bases)]
    rows = list(enumerate(bases + copies + [sentence(draw, n, 4) for n in range(1, 9)]))
    docs = frame(spark, rows)
    got = {r["doc_id"] for r in dict(pipeline.STAGES)["near copies"](spark, docs, "").collect()}
    assert got == {c for _, _, c in near_brute(rows, percent=80, shingle=5)}
    assert got & set(range(12, 24)) == {13, 15, 17, 19, 21, 23}


@pytest.fixture
def settings(spark):
    """Sets Spark's settings for one test."""
    before = {}

    def put(values):
        before.update({k: spark.conf.get(k) for k in values})
        for k, v in values.items():
            spark.conf.set(k, v)

    yield put
    for k, v in before.items():
        spark.conf.set(k, v)


def test_run_and_rerun(spark, tmp_path):
    frame(spark, [(i, t) for i, t, *_ in corpus()]).write.parquet(f"{tmp_path}/documents.parquet")
    one, two = (pipeline.run(spark, str(tmp_path)).collect() for _ in range(2))
    strip = lambda rows: sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in rows)
    assert strip(one) == strip(two)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in pipeline.STAGES:
        docs = pipeline.written(stage(spark, docs, ""), "test-empty")
    assert docs.count() == 0


def stage(spark, name, rows):
    out = dict(pipeline.STAGES)[name](spark, spark.createDataFrame(rows, SCHEMA), "")
    return out.collect()


def test_rows_without_or_with_shared_identifiers_stay_rows(spark):
    """Nothing is multiplied or kept for the sake of another row with its identifier."""
    draw = random.Random(3)
    own = [sentence(draw, 60, 10_000) for _ in range(50)]
    shared = [(None if i % 2 else 7, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(own)]
    got = stage(spark, "mix", shared)
    copies = {}
    for r in got:
        copies[r["text"]] = copies.get(r["text"], 0) + 1
    assert set(copies) <= set(own) and max(copies.values()) <= 3
    for name, goal in shares({f"s{k}": 60 * len(range(k, 50, 3)) for k in range(3)}).items():
        assert abs(60 * sum(r["source"] == name for r in got) - goal) <= 60

    copy = (None, own[0].replace(own[0].split()[3], "edited"), "en", "s", 9)
    rows = [(1, own[0], "en", "s", 9), copy, (None, own[1], "en", "s", 9), (1, own[2], "en", "s", 9)]
    got = stage(spark, "near copies", rows + rows[:1] * 3)
    assert sorted(r["text"] for r in got) == sorted(own[:3])
    assert {r["doc_id"] for r in got if r["text"] == own[0]} == {1}


def test_stages_on_awkward_rows(spark):
    """Nulls, equal identifiers, repeated rows and very long texts, through every stage."""
    draw = random.Random(9)
    long = sentence(draw, 60_000, 30_000)
    rows = [(i, t, None, None if i and i % 4 == 0 else "s", 1) for i, t in awkward()]
    rows += [(500, long, "en", "s", 1), (501, long + " end", "en", "s", 1)]
    lettered = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    got = stage(spark, "language", rows)
    assert sorted((str(r["doc_id"]), r["text"]) for r in got) == sorted((str(i), t) for i, t, *_ in lettered)
    docs = got
    for name in ("near copies", "shared passages", "mix"):
        before, docs = docs, stage(spark, name, [tuple(r) for r in docs])
        if name == "near copies":
            numbered = [(i, r["text"]) for i, r in enumerate(before)]
            groups = {c for _, _, c in near_brute(numbered, percent=80, shingle=5)}
            assert len(docs) == len(groups)
            assert len({r["text"] for r in docs}) == len(docs)
        assert docs
    placed = stage(spark, "pack", [tuple(r) for r in docs])
    library = tokens.encoder(tokens.vocabulary_path()).library
    assert sum(r["length"] for r in placed) == sum(
        len(library.encode(r["text"], add_special_tokens=False).ids) + 1 for r in docs
    )


def test_mix_shuffles_no_texts_for_its_copies(spark, settings):
    """The copies of 20,000 documents are broadcast as a few kilobytes, and each text comes as often."""
    settings({"spark.sql.autoBroadcastJoinThreshold": "16k"})
    rows = [(i % 700 or None, f"{'w ' * (i % 5)}x{i}", "en", f"s{i % 3}", 9) for i in range(20_000)]
    docs = pipeline.written(spark.createDataFrame(rows, SCHEMA), "test-mix")
    out = dict(pipeline.STAGES)["mix"](spark, docs, "")
    told = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in told and "SortMergeJoin" not in told
    got = out.collect()
    numbered = pipeline._numbered(docs, "rows")
    mixed = mixing.mix(numbered, "row", drawn_by=("doc_id", "text"))
    assert sorted(got, key=repr) == sorted(mixing.repeat(numbered, mixed, "row").select(*pipeline.COLUMNS).collect(), key=repr)
    with pytest.raises(Exception, match="missing in the mix"):
        mixing.repeat_numbered(numbered, mixed.filter("row != 0"), "row").collect()


def test_language_rejects_by_the_stated_rule(spark):
    """No letter, or a score no better than a guess; without labels only the former."""
    texts = {"en": "the thing that they have", "fr": "le chat est dans la maison"}
    rows = [(i, f"{texts[k]} {i}", k, "s", 9) for k in texts for i in range(40)]
    odd = [(100, "12 34", "en", "s", 9), (101, "the have 9", None, "s", 9)]
    got = stage(spark, "language", rows + odd)
    assert {r["doc_id"] for r in got} == set(range(40)) | {101}
    assert [r["lang"] for r in got if r["doc_id"] == 101] == ["en"]
    unlabelled = [(i, t, None, s, n) for i, t, _, s, n in rows + odd]
    assert len(stage(spark, "language", unlabelled)) == len(rows) + 1
    model = lang.train(lang.vectors(*_packed(texts.values())), list(texts))
    df = spark.createDataFrame([("en", 0.25, "a"), ("en", 0.26, "a"), ("und", 0.0, "1")], "p string, s double, t string")
    judged = df.select(lang.rejected(F.col("p"), F.col("s"), F.col("t"), model).alias("r")).collect()
    assert [r["r"] for r in judged] == [True, False, True]


def _packed(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])
