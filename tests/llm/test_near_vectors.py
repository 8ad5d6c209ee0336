import random

import numpy as np
from pyspark.sql import functions as F

from caretrail.llm.components import components
from caretrail.llm.near_vectors import Grid, enough, near_vectors, train_grids, unit, usable
from caretrail.llm.stored import Scratch


def brute(rows, cosine=0.98):
    """By row: links; by id: component."""
    ok = [i for i, (v, e, lab, *_) in enumerate(rows) if v is not None and lab is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    links = {i: set() for i in range(len(rows))}
    for i in ok:
        for j in ok:
            if i < j and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = (np.array(rows[k][1], float) / max(map(abs, rows[k][1])) for k in (i, j))
                if a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= cosine:
                    links[i].add(j)
                    links[j].add(i)
    return links, union([(rows[i][0], rows[j][0]) for i in links for j in links[i]])


def union(pairs):
    top = {}

    def root(x):
        while top.get(x, x) != x:
            x = top[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        top[max(a, b)] = min(a, b)
        top.setdefault(min(a, b), min(a, b))
    return {x: root(x) for x in top}


def test_components_of_random_graphs(spark):
    dice = random.Random(0)
    chain = [(i, i + 1) for i in range(0, 400)]
    star = [(1000, i) for i in range(1001, 1600)]
    loose = [(dice.randrange(2000, 3000), dice.randrange(2000, 3000)) for _ in range(600)]
    pairs = [*chain, *star, *loose, (5, 5)]
    dice.shuffle(pairs)
    df = spark.createDataFrame(pairs, "a long, b long").repartition(7)
    out = {r.id: r.component for r in components(df, Scratch(spark, "test")).collect()}
    expected = union(pairs)
    assert out == {k: v for k, v in expected.items() if k != v}
    assert components(df.limit(0), Scratch(spark, "test")).count() == 0


def test_hot_cell_and_odd_rows(spark):
    dice = np.random.default_rng(1)
    centre, rows = dice.normal(size=16), []
    rows += [(i, [float(x) for x in centre + dice.normal(size=16) * 0.05], 1, "x") for i in range(300)]  # one hot cell
    rows += [(300 + i, [float(x) for x in dice.normal(size=16)], i % 3, None) for i in range(200)]
    line = [[float(np.cos(t)), float(np.sin(t))] + [0.0] * 14 for t in np.arange(0, 2, 0.15)]  # each linked to the next only
    rows += [(900 - i, v, 7, "y") for i, v in enumerate(line)]
    rows += [(1000, None, 1, "x"), (1001, [0.0] * 16, 1, "x"), (1002, [float("nan")] + [1.0] * 15, 1, "x"), (1003, [1.0, None], 1, "x")]
    rows += [(None, rows[0][1], 1, "x"), (1004, rows[0][1], None, "x"), (1005, [], 1, "x"), (1006, [1e300] * 16, 1, "x"), (1007, [1e-200] * 16, 1, "x")]
    rows += [rows[0], rows[0], (1008, [1.0, 2.0, 3.0], 1, "x"), (1009, [2.0, 4.0, 6.0], 1, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, component_id string").repartition(4)
    out = near_vectors(df, recall=1.0, block=40).collect()
    links, component = brute(rows)
    expected = sorted([(str(r[0]), len(links[i]), component.get(r[0], r[0])) for i, r in enumerate(rows)], key=str)
    assert sorted([(str(r.vec_id), r.n_links, r.component_id) for r in out], key=str) == expected
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in out)
    assert near_vectors(df.limit(0)).count() == 0


def test_embeddings_equal_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, list(map(float, r.embedding)), r.label) for r in df.collect()]
    links, component = brute(rows)
    out = {r.vec_id: r for r in near_vectors(df).collect()}
    assert len(out) == len(rows)
    found = sum(out[r[0]].n_links for r in rows)
    assert found >= 0.99 * sum(map(len, links.values()))
    assert all(out[r[0]].n_links <= len(links[i]) for i, r in enumerate(rows))
    assert sum(out[r[0]].component_id == component.get(r[0], r[0]) for r in rows) >= 0.99 * len(rows)


def test_multi_sequence_order():
    dice = np.random.default_rng(2)
    x = unit(dice.normal(size=(60, 8)))
    grid = Grid(x, 6, -1.0)  # everything is within reach
    one, two = grid.both(x)
    for row, cells in enumerate(grid.visited(x, 36)):
        sums = [one[row, c // 6] + two[row, c % 6] for c in cells]
        assert sums == sorted(sums) and len(set(cells)) == 36 and cells[0] == grid.home(x)[row]


def test_small_groups_beside_a_hot_one(spark):
    dice = np.random.default_rng(5)
    rows = [(i, [float(v) for v in np.eye(16)[0]], 1) for i in range(600)]  # copies, all in one cell
    for i in range(600):  # pairs just within reach, often of different cells
        v = unit(dice.normal(size=(1, 16)))[0]
        w = dice.normal(size=16)
        w -= (w @ v) * v
        w = v * 0.982 + w / np.sqrt(w @ w) * np.sqrt(1 - 0.982**2)
        rows += [(1000 + 2 * i, list(map(float, v)), 1), (1001 + 2 * i, list(map(float, w)), 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    links, component = brute(rows)
    out = {r.vec_id: r for r in near_vectors(df, codewords=16).collect()}
    small = [i for i, r in enumerate(rows) if r[0] >= 1000]
    found = sum(out[rows[i][0]].n_links for i in small)
    assert 0.998 * sum(len(links[i]) for i in small) <= found <= sum(len(links[i]) for i in small)
    assert sum(out[rows[i][0]].component_id == component.get(rows[i][0], rows[i][0]) for i in small) >= 0.998 * len(small)

    # Few askers show nothing: all cells within reach are asked, and nothing is lost.
    given = usable(df, "vec_id", "embedding", "label").withColumn("row", F.monotonically_increasing_id()).cache()
    assert train_grids(given, 0.98, 0.999, 20_000, 16, values=16 * 100)[16].visits is None
    exact = {r.vec_id: r for r in near_vectors(df, codewords=16, values=16 * 100).collect()}
    assert all(exact[r[0]].n_links == len(links[i]) and exact[r[0]].component_id == component.get(r[0], r[0]) for i, r in enumerate(rows))


def test_enough_visits():
    assert enough({}, 0.0, 0.0, False, 0.999, 64) is None and enough({}, 0.0, 0.0, True, 0.999, 64) == 1
    assert enough({1: 9.0, 3: 1.0}, 10.0, 1.0, True, 0.9, 64) == 1 and enough({1: 9.0, 3: 1.0}, 10.0, 1.0, True, 0.95, 64) == 3
    assert enough({1: 5000.0}, 5000.0, 5000.0, False, 0.999, 64) == 1 and enough({1: 500.0}, 500.0, 500.0, False, 0.999, 64) is None
    assert enough({1: 9.0, 65: 1.0}, 10.0, 1.0, True, 0.95, 64) is None
