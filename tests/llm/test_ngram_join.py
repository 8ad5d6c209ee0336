import random
import re

import numpy as np
import pyarrow as pa
import pytest

from caretrail.llm.ngram_join import (
    Sets, apart_links, bands, document_components, linked, may_link, node_texts, one_of_each, signatures, sketches, unpacked_sets,
)
from caretrail.llm.stored import Scratch
from caretrail.llm.words import SPACES, Words, column_bytes


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute(rows):
    """Per row (doc_id, n_shingles, component_id)."""
    sets = [shingles(t) for _, t, *_ in rows]
    top = list(range(len(rows)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) * 4 >= max(len(a), len(b)) * 3:
                shared = len(a & b)
                if 100 * shared >= 75 * (len(a) + len(b) - shared):
                    x, y = root(i), root(j)
                    top[max(x, y)] = min(x, y)
    members = {}
    for i, r in enumerate(rows):
        members.setdefault(root(i), []).append(r[0])
    least = {k: min((m for m in v if m is not None), default=None) for k, v in members.items()}
    return sorted(((r[0], len(sets[i]), least[root(i)]) for i, r in enumerate(rows)), key=str)


def run(spark, rows, **named):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, node string, component_id int").repartition(3)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in document_components(df, **named).collect()), key=str)


def corpus(dice):
    vocabulary = [f"w{i}" for i in range(4000)]
    passage = [dice.choice(vocabulary) for _ in range(60)]  # quoted by many unlike documents
    rows, bodies = [], []
    for i in range(260):
        body = [dice.choice(vocabulary) for _ in range(dice.choice([3, 6, 9, 14, 30, 60, 150, 400]))]
        if i % 2:
            at = dice.randrange(len(body))
            body[at:at] = passage
        bodies.append(body)
    for i in range(220):  # copies with edits, about the threshold
        body = list(dice.choice(bodies))
        for _ in range(dice.randrange(1, 2 + len(body) // 25)):
            body[dice.randrange(len(body))] = dice.choice(vocabulary)
        bodies.append(body)
    base = [dice.choice(vocabulary) for _ in range(80)]
    for _ in range(120):  # a large group
        body = list(base)
        for _ in range(dice.randrange(0, 3)):
            body[dice.randrange(len(body))] = dice.choice(vocabulary)
        bodies.append(body)
    rows = [(i, dice.choice([" ", "\n", "\t "]).join(b)) for i, b in enumerate(bodies)]
    rows += [(5000 + i, rows[i][1].upper()) for i in range(30)]
    rows += [(None, rows[3][1]), (9000, None), (9001, ""), (9002, " \n "), (9003, "a"), (9004, "A"), (9005, "a b"), (None, None), rows[7], rows[7]]
    rows += [(9100, "x\x00y z"), (9101, "é É"), (9102, "w " * 3000), (9103, "w " * 2999)]
    return rows


def test_equals_brute_force(spark):
    rows = corpus(random.Random(1))
    assert run(spark, rows) == brute(rows)


def test_documents_equal_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in document_components(df).collect()), key=str) == brute(rows)


def test_one_row_of_each_group_stays(spark):
    rows = [(i, t) for i, t in corpus(random.Random(2)) if t != "never"]
    df = spark.createDataFrame([(*r, "src", None) for r in rows], "doc_id long, text string, node string, content int").repartition(3)
    out = [tuple(r) for r in one_of_each(df).collect()]
    assert one_of_each(df).columns == df.columns and {r[2:] for r in out} == {("src", None)}
    full = brute(rows)
    with_id = {c for d, n, c in full if n and c is not None}
    assert sorted(r[0] for r in out if shingles(r[1]) and r[0] is not None) == sorted(with_id)
    assert sum(not shingles(r[1]) for r in out) == sum(not shingles(t) for _, t in rows)
    assert not [r for r in out if shingles(r[1]) and r[0] is None]
    lone = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (None, None)], "doc_id long, text string")
    assert sorted(r.text or "" for r in one_of_each(lone).collect()) == ["", "a b c d e f"]


def test_empty_table(spark):
    assert document_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_linked_sets_share_as_many_signatures_as_promised(seed):
    dice = random.Random(seed)
    texts = []
    for _ in range(60):
        body = [f"v{dice.randrange(10**6)}" for _ in range(dice.randrange(6, 300))]
        other = list(body)
        for _ in range(dice.randrange(0, 1 + len(body) // 30)):
            other[dice.randrange(len(other))] = "new"
        texts += [" ".join(body), " ".join(other + ["more"] * dice.randrange(3))]
    data, starts = column_bytes(pa.array(texts))
    sets = Sets(data, starts)
    signed = signatures(sets)
    parities = sketches(sets)
    own = [dict(zip(signed.sign[signed.row == i].tolist(), zip(signed.band[signed.row == i].tolist(), signed.spare[signed.row == i].tolist(), strict=True), strict=True)) for i in range(len(texts))]
    top, most, parts = bands(2000)
    for i in range(0, len(texts), 2):
        a, b = set(sets.of(i).tolist()), set(sets.of(i + 1).tolist())
        if a != b and 100 * len(a & b) >= 75 * len(a | b):
            band = int(np.searchsorted(top, len(a) + len(b)))
            agreed = [k for k in own[i] if k in own[i + 1] and own[i][k][0] == band]
            assert len(agreed) > max(own[i][agreed[0]][1], own[i + 1][agreed[0]][1])
            assert len(a ^ b) <= most[band] < parts[band]
        args = parities[i], parities[i + 1], len(a), len(b), 75
        assert may_link(*args) or 100 * len(a & b) < 75 * len(a | b)


def test_members_in_blocks_connect_what_all_pairs_connect(spark):
    """Whatever the blocks, the links given are links between components, and connect as much as all links of a large sign do."""
    dice = random.Random(5)
    base = [f"v{i}" for i in range(70)]
    texts = []
    for _ in range(90):
        body = list(base)
        for _ in range(dice.randrange(0, 4)):
            body[dice.randrange(len(body))] = f"n{dice.randrange(10**6)}"
        texts.append(" ".join(body[: dice.choice([70, 70, 40])]))
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    scratch = Scratch(spark, "test-blocks")
    table = scratch.store(node_texts(df, 5).dropDuplicates(["node"]), "texts")
    rows = table.collect()
    component = {r.node: r.node % 7 + (r.node % 2) * r.node for r in rows}  # some together, some alone
    named = spark.createDataFrame([(1, r.node, component[r.node]) for r in rows], "sign long, node long, component long")
    sets = dict(zip([r.node for r in rows], unpacked_sets([r.packed for r in rows], 5), strict=True))
    expected = set()
    for i, a in enumerate(rows):
        for b in rows[:i]:
            assert may_link(a.sketch, b.sketch, a.size, b.size, 75) or not linked(sets[a.node], sets[b.node], 75)
            if component[a.node] != component[b.node] and linked(sets[a.node], sets[b.node], 75):
                expected.add((max(a.node, b.node), min(a.node, b.node)))

    def together(pairs):
        top = {c: c for c in component.values()}
        for x, y in pairs:
            a, b = top[component[x]], top[component[y]]
            top = {c: min(a, b) if t in (a, b) else t for c, t in top.items()}
        return top

    for block, size in ((8, 1 << 20), (1000, 1 << 20), (1000, 700)):
        out = {(r.x, r.y) for r in apart_links(named, table, Scratch(spark, "test-blocks"), 5, 75, block, size).collect()}
        assert out <= expected and together(out) == together(expected)
        assert block < 1000 or size < 1000 or len(out) < len(set(component.values())) < len(expected)


def test_one_large_group_of_near_copies_grows_in_proportion(spark, monkeypatch):
    """No stored table, the outputs of the joins among them, grows faster than the group."""
    dice = random.Random(8)
    words = [f"w{i}" for i in range(120)]

    def text():
        body = list(words)
        for _ in range(dice.randrange(0, 6)):
            body[dice.randrange(len(body))] = f"x{dice.randrange(10**7)}"
        return " ".join(body)

    texts, rows, held = [text() for _ in range(1200)], {}, Scratch.store

    def store(self, df, name):
        out = held(self, df, name)
        rows.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(Scratch, "store", store)
    for n in (300, 600, 1200):
        table = spark.createDataFrame(list(enumerate(texts[:n])), "doc_id long, text string")
        assert document_components(table).select("component_id").distinct().count() < n / 2
        assert rows["apart-links"][-1] <= n
    for name in ("spokes", "named", "mixed", "apart-links", "few", "pairs", "group", "rows"):
        few, some, many = rows[name]
        assert many <= 2.5 * max(some, 300) and some <= 2.5 * max(few, 300), (name, rows[name])


def test_nul_belongs_to_a_word(spark):
    rows = [(1, "a\x00b c d e f g"), (2, "a b c d e f g"), (3, "\x00"), (4, "\x00\x00 \x00"), (5, "A\x00B c d e f g"), (6, "one\x00 two \x00three four five six\x00seven")]
    assert run(spark, rows) == brute(rows)
    texts = [t for _, t in rows]
    data, starts = column_bytes(pa.array(texts))
    words = Words(data, starts, SPACES)
    got = [data[a:b].tobytes().decode() for a, b in zip(words.start, words.end, strict=True)]
    assert got == [w for t in texts for w in re.findall(r"[^\x20\x09-\x0d]+", t)]
