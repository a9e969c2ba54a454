"""Different words stay different: words that share a polynomial hash whatever its base."""

import numpy as np
import pytest

from tallybook.llm import packing, rlz, tgm, tokens
from tallybook.llm.common import word_keys
from tests.llm.fixtures import frame

FILL = "one two three four five six seven eight nine ten"


def thue_morse(n, letters="ab"):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


def keys(words):
    data = [w.encode() for w in words]
    ends = np.cumsum([len(x) for x in data])
    return word_keys(np.frombuffer(b"".join(data), np.uint8), ends - [len(x) for x in data], ends)


@pytest.mark.parametrize("n", [512, 1024, 2048, 8192])
def test_words_of_special_form(spark, n):
    a, b = thue_morse(n), thue_morse(n, "ba")
    docs = frame(spark, [(1, a), (2, b)])
    got = {r["doc_id"]: r["ids"] for r in packing.pieces(docs, 10**6, with_ids=True).collect()}
    library = tokens.encoder(tokens.vocabulary_path()).library
    assert got == {i: [*library.encode(t, add_special_tokens=False).ids, 0] for i, t in ((1, a), (2, b))}
    lengths = {r["doc_id"]: r["n_tokens"] for r in tokens.encoded_lengths(docs).collect()}
    assert lengths == {i: len(x) - 1 for i, x in got.items()}
    assert {r["component_id"] for r in tgm.jaccard_components(docs).collect()} == {1, 2}
    texts = [" ".join(FILL.split() * 3 + [f"w{i}" for i in range(4)]) + " " + w for i, w in enumerate((a, b)) for i in (0,)]
    kept = rlz.drop_repeats(frame(spark, list(enumerate(texts)))).collect()
    assert [r["n_removed"] for r in kept] == [0, 0]


def test_keys_depend_on_every_byte_and_the_length():
    words = ["a", "aa", "a" * 8, "a" * 9, "b" + "a" * 8, "a" * 8 + "b", "a" * 512, "a" * 513, "a" * 512 + "b", "a\x00", "\x00a", "\x00"]
    assert len(set(keys(words).tolist())) == len(words)
    assert keys(["xyz", "long word " * 80])[1] == keys(["long word " * 80])[0]
