import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from caretrail.llm import suffix_dedup
from caretrail.llm.suffix_dedup import BlindTrie, deep_shallow, sliding_min, suffix_digest


def brute(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def run(spark, texts, length):
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, tid string").repartition(3)
    out = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_digest(df, length).collect()}
    assert len(out) == len(rows)
    return [out[i] for i in range(len(rows))]


def corpus(dice, length):
    letters = lambda n: "".join(dice.choice("abcdefgh é") for _ in range(n))
    passages = [letters(dice.randrange(length - 5, 4 * length)) for _ in range(6)]
    texts = [None, "", "short", "a" * (3 * length), "ab" * (2 * length), "a" * (length - 1), "x" * length, letters(length)]
    for _ in range(120):
        body = letters(dice.randrange(0, 6 * length))
        for _ in range(dice.randrange(3)):
            p = dice.choice(passages)
            a = dice.randrange(len(p))
            cut = p[a : a + dice.randrange(length // 2, 3 * length)]
            at = dice.randrange(len(body) + 1)
            body = body[:at] + cut + body[at:]
        texts.append(body)
    for _ in range(25):  # copies, and copies with one change
        body = dice.choice(texts[8:])
        texts.append(body)
        at = dice.randrange(len(body) + 1)
        texts.append(body[:at] + "#" + body[at + 1 :])
    return texts


@pytest.mark.parametrize("length", [40, 200])
def test_equals_brute_force(spark, length):
    texts = corpus(random.Random(length), length)
    assert run(spark, texts, length) == brute(texts, length)


def test_string_with_many_contexts(spark, monkeypatch):
    """A passage in very many texts, so that its contexts are sorted in parts and compared across them."""
    monkeypatch.setattr(suffix_dedup, "PART", 12)
    dice = random.Random(7)
    passage = "".join(dice.choice("abcdefghijkl") for _ in range(60))
    word = lambda n: "".join(dice.choice("mnopqrst") for _ in range(n))
    ends = [word(30) for _ in range(9)]  # shared further on by some
    texts = [word(40) + (dice.choice(ends) if dice.random() < 0.5 else "") + passage + (dice.choice(ends) if dice.random() < 0.5 else "") + word(40) for _ in range(200)]
    assert run(spark, texts, 50) == brute(texts, 50)


def test_documents_equal_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = df.collect()
    out = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_digest(df).collect()}
    assert [out[r.doc_id] for r in rows] == brute([r.text for r in rows], 200)


def test_odd_rows(spark):
    rows = [(None, "q" * 300), (None, "q" * 300), (1, None), (1, None), (2, "z" * 199)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in suffix_digest(df).collect()), key=str)
    assert out == sorted([(None, 300, 300, 1)] * 2 + [(1, 0, 0, 0)] * 2 + [(2, 199, 0, 0)], key=str)
    assert suffix_digest(df.limit(0)).count() == 0


def test_deep_shallow_orders():
    dice = np.random.default_rng(0)
    texts = dice.integers(97, 99, size=(500, 70)).astype(np.uint8)
    texts[100:300, :40] = texts[0, :40]  # long common prefixes go to the tries
    texts[300:330] = texts[5]
    group = np.sort(dice.integers(0, 4, size=500))
    order = deep_shallow(group, texts)
    rows = [(int(group[i]), texts[i].tobytes()) for i in order]
    assert rows == sorted(rows) and sorted(order.tolist()) == list(range(500))


def test_blind_trie():
    trie, words = BlindTrie(), [b"abcx", b"abcd", b"abca", b"zbca", b"abcd", b"aaaa"]
    for i, w in enumerate(words):
        trie.add(i, w)
    assert [words[i] for i in trie.order()] == sorted(words)


def test_sliding_min():
    values = np.random.default_rng(1).integers(0, 100, 57).astype(np.uint64)
    assert sliding_min(values, 9).tolist() == [int(values[i : i + 9].min()) for i in range(49)]
