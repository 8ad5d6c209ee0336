import random
import re

import numpy as np
import pyarrow as pa

from caretrail.llm.decontaminate import Benchmark, align, leaks, without_leaks
from caretrail.llm.words import PLAIN, SPACES, Words, column_bytes


def words_of(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def distance(item, text):
    """Fewest edits between the item and any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        row, last = [i], row
        for j, v in enumerate(text, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (w != v)))
    return min(row)


def brute(documents, items, max_edits=0.2):
    found = {}
    for at, text in enumerate(documents):
        for item_id, item in items:
            own = words_of(item)
            if own and (d := distance(own, words_of(text))) <= int(len(own) * max_edits + 1e-9):
                found[at, item_id] = d
    return found


def edited(words, edits, dice):
    words = list(words)
    for _ in range(edits):
        at, kind = dice.randrange(len(words)), dice.randrange(3)
        words[at : at + (kind < 2)] = [] if kind == 0 else ["new%d" % dice.randrange(10**6)]
    return words


def test_planted_copies_are_found(spark):
    dice = random.Random(4)
    word = lambda: dice.choice(["of", "the", "and"]) if dice.random() < 0.4 else "w%d" % dice.randrange(3000)
    items = [(i, " ".join(word() for _ in range(dice.choice([6, 9, 20, 40, 70])))) for i in range(30)]
    documents, planted = [], 0
    for n in range(240):
        body = [word() for _ in range(dice.randrange(5, 200))]
        own = words_of(items[n % 30][1])
        edits = dice.randrange(0, len(own) // 3)
        at = dice.randrange(len(body))
        body[at:at] = edited(own, edits, dice)
        documents.append((", " if n % 2 else " ").join(body).upper())
    documents += [None, "", "of the"] + [documents[0]] * 3
    rows = [(i, t, "x", 1) for i, t in enumerate(documents)]
    df = spark.createDataFrame(rows, "doc_id long, text string, item_id string, edits int").repartition(3)
    bench = spark.createDataFrame([*items, (90, None), (91, ""), (92, "!!")], "item_id long, text string")
    expected = brute(documents, items)
    out = {(r.doc_id, r.item_id): r for r in leaks(df, bench, block=20).collect()}
    assert set(out) <= set(expected), "no pair beyond the distance"
    assert all(out[k].edits == expected[k] for k in out)
    assert len(out) / len(expected) >= 0.98
    assert all(k in out for k, d in expected.items() if d == 0)
    for (at, _), r in out.items():
        stretch = documents[at].encode()[r.start : r.end].decode()
        own = words_of(dict(items)[r.item_id])
        assert distance(own, words_of(stretch)) == r.edits
    kept = {r.doc_id for r in without_leaks(df, bench).collect()}
    assert kept == {i for i in range(len(documents))} - {k[0] for k in out}
    assert without_leaks(df, bench).columns == df.columns


def test_documents_equal_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    documents, bench = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "benchmark"))
    items = [(r.item_id, r.text) for r in bench.collect()]
    rows = documents.collect()
    near = [r for r in rows if len(r.text or "") < 2500][:80]
    expected = {(near[a].doc_id, i): d for (a, i), d in brute([r.text for r in near], items).items()}
    out = {(r.doc_id, r.item_id): r.edits for r in leaks(documents, bench).collect() if r.doc_id in {x.doc_id for x in near}}
    assert out == expected


def test_empty_tables(spark):
    documents = spark.createDataFrame([(1, "a b c"), (None, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c"), (None, "c")], "item_id long, text string")
    assert leaks(documents, bench.limit(0)).count() == 0 and without_leaks(documents, bench.limit(0)).count() == 2
    assert leaks(documents.limit(0), bench).count() == 0
    assert {(r.doc_id, r.item_id) for r in leaks(documents, bench).collect()} == {(1, 1), (1, None)}


def test_align():
    a = np.array([1, 2, 3, 4], np.uint64)
    assert align(a, np.array([9, 1, 2, 3, 4, 9], np.uint64)) == (0, 1, 5)
    assert align(a, np.array([9, 1, 3, 4, 9], np.uint64)) == (1, 1, 4)
    assert align(a, np.array([], np.uint64))[0] == 4


def test_words_of_a_batch():
    texts = ["One two", None, "", "x\x00y THREE", "é-é", "  a "]
    for table, split in ((SPACES, lambda t: re.findall(r"[^\x20\x09-\x0d]+", t)), (PLAIN, lambda t: words_of(t))):
        data, starts = column_bytes(pa.array(texts).slice(1))
        words = Words(data, starts, table)
        got = [[] for _ in texts[1:]]
        for r, a, b in zip(words.row, words.start, words.end, strict=True):
            got[r].append(data[a:b].tobytes().decode())
        expected = [split(t or "") for t in texts[1:]]
        if table is PLAIN:
            assert [[w.lower() for w in g] for g in got] == expected
        else:
            assert [[p for w in split(t or "") for p in [w]] for t in texts[1:]] == got or "\x00" in "".join(map(str, texts))
        one = {}
        for r, a, b, h in zip(words.row, words.start, words.end, words.hash, strict=True):
            assert one.setdefault(data[a:b].tobytes().lower(), h) == h


def test_recall_target_sets_the_walks():
    dice = np.random.default_rng(0)
    items = [(i, dice.integers(1 << 62, size=40).astype(np.uint64)) for i in range(50)]
    assert 1 <= Benchmark(items, recall=0.5).walks <= Benchmark(items, recall=0.99).walks


def test_classes_out_of_reach_are_verified_exactly():
    dice = np.random.default_rng(3)
    items = [(i, dice.integers(1 << 62, size=8).astype(np.uint64)) for i in range(300)]
    items += [(300 + i, dice.integers(1 << 62, size=200).astype(np.uint64)) for i in range(3)]  # few long ones among many short
    few = Benchmark(items, recall=0.99, most_walks=2)
    assert few.exact[300:].all()
    assert Benchmark(items[:300], max_edits=0.0).exact.sum() == 0

    words = [[f"w{i}x{j}" for j in range(200)] for i in range(3)]
    texts = []
    for own in words:
        for turn in range(10):  # as many edits as a match may have, spread so that long runs stay
            text = list(own)
            for j in range(40):
                text[(turn + 5 * j) % 160 if j % 2 else 160 + j] = f"z{j}"
            texts.append(" ".join(["a", *text, "b"]))
    column = pa.array([" ".join(w) for w in words])
    data, starts = column_bytes(column)
    hashes = Words(data, starts, PLAIN)
    long = [(i, hashes.hash[hashes.first[i] : hashes.first[i + 1]]) for i in range(3)]
    bench = Benchmark(long, recall=0.99, most_walks=1)
    assert bench.exact.all()
    found = bench.find(pa.array(texts))
    assert all(i // 10 in found.get(i, {}) for i in range(len(texts)))
