"""Small inputs: documents with every awkward case, and the brute-force helpers for them."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, texts, schema=SCHEMA):
    """Documents of (id, text) or whole rows."""
    rows = [
        (*r, "en", f"s{i % 3}", len(r[1] or "")) if len(r) == 2 else tuple(r) for i, r in enumerate(texts)
    ]
    return spark.createDataFrame(rows, schema)


def words_of(text):
    return WORD.findall(text or "")


def sentence(draw, n, vocabulary=400):
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(n))


def awkward(seed=1):
    """Nulls, empty texts, repeated rows, copies, shared passages, near copies, long words."""
    draw = random.Random(seed)
    passage = sentence(draw, 60)
    base = sentence(draw, 120)
    texts = [None, "", " \n\t ", "one", "one two", "É" * 300, "x" * 5000, "a b " * 60]
    texts += [sentence(draw, draw.randrange(1, 200)) for _ in range(25)]
    texts += [base, base, base.upper(), base + " tail", "head " + base]
    texts += [sentence(draw, 40) + " " + passage + "\n" + sentence(draw, 30) for _ in range(12)]
    texts += [passage + " " + passage, "ab " * 200, "日本語 テキスト " * 40]
    for _ in range(8):  # near copies
        own = base.split()
        own[draw.randrange(len(own))] = "edited"
        texts.append(" ".join(own))
    rows = [(i * 7 % 101 + 1, t) for i, t in enumerate(texts)]
    rows += [rows[20], rows[20], (None, base), (None, passage)]  # repeated rows, no identifier
    return rows
