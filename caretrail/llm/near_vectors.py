"""Near duplicates among embeddings: an inverted multi-index, traversed until target recall, and exact cosines.

Unit vectors are cut in halves, and each half has its own codebook; the pairs of codewords are the cells of a product grid.
Every vector lies in the cell of its nearest codewords and asks the cells nearest to it, in multi-sequence order
(by the sum of both distances), for vectors of its own label. Cells that no vector within reach can lie in, by the distance to the
border of a codeword's region, are passed over. How many cells it asks is set by the links of a bounded set of askers, found by brute
force against all rows; each asker weighs as its share of a group of copies. Where these do not show the target recall, a vector
asks all cells within reach, which loses no link. All candidates get an exact cosine in double precision, and a link counts for both its
vectors whichever of them found it.

A cell with many vectors of a label is dealt in blocks, each block of askers against each block of its vectors, so no task
gets a whole hot cell. A task returns counts for its askers and a spanning forest of its links, not the links.

Defined cases: a vector that is null, empty, zero, or holds null or non-finite components, or whose label or id is null, links with
nothing; its component is its own id. Vectors of different length do not link. Rows that repeat an id are vectors of their
own, each counting the others; their id is one member of a component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caretrail.llm.components import components
from caretrail.llm.stored import Scratch

REACH = "kind int, n long, a long, b long"


def can_link(vec_id: str, embedding: str, label: str) -> Column:
    vector = F.col(embedding)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    given = F.col(vec_id).isNotNull() & F.col(label).isNotNull()
    return given & F.coalesce(finite, F.lit(False)) & F.coalesce(some, F.lit(False))


def usable(df: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """Rows that can link, as (vec_id, label, dim, vector); vector is the array in double precision."""
    vector = F.col(embedding).cast("array<double>")
    return df.where(can_link(vec_id, embedding, label)).select(
        F.col(vec_id).alias("vec_id"), F.col(label).cast("string").alias("label"), F.size(embedding).alias("dim"), vector.alias("vector")
    )


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow on the way to the length
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def distances(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ codes.T + (codes * codes).sum(1), 0)


def codebook(x: np.ndarray, size: int, seed: int, rounds: int = 12) -> np.ndarray:
    """k-means of one half."""
    codes = x[np.random.default_rng(seed).permutation(len(x))[:size]].copy()
    for _ in range(rounds):
        own = distances(x, codes).argmin(1)
        sums, counts = np.zeros_like(codes), np.bincount(own, minlength=len(codes))
        np.add.at(sums, own, x)
        codes = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], codes)
    return codes


class Grid:
    """Codebooks of both halves of one vector length, and how many cells an asker visits."""

    def __init__(self, x: np.ndarray, size: int, cosine: float):
        self.half, self.reach2 = x.shape[1] // 2, 2 - 2 * cosine
        self.codes = [codebook(h, max(1, min(size, len(x))), seed) for seed, h in enumerate(self.halves(x))]
        self.visits = 1

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, : self.half], x[:, self.half :]

    def both(self, x: np.ndarray) -> list[np.ndarray]:
        return [distances(h, c) for h, c in zip(self.halves(x), self.codes, strict=True)]

    def home(self, x: np.ndarray) -> np.ndarray:
        a, b = (d.argmin(1) for d in self.both(x))
        return a * len(self.codes[1]) + b

    def visited(self, x: np.ndarray, most: int | None) -> list[list[int]]:
        """Cells in multi-sequence order, the nearest `most` within reach.

        With None all within reach from the home cell's number on: of two vectors of different cells, one asks for the other.
        """
        one, two = self.both(x)
        borders = []
        for d, c in zip((one, two), self.codes, strict=True):
            best = d.argmin(1)
            apart = np.sqrt(distances(c, c))[best]
            low = (d - d.min(1, keepdims=True)) / (2 * np.maximum(apart, 1e-300))
            low[np.arange(len(d)), best] = 0
            borders.append(low * low)
        width, out = len(self.codes[1]), []
        for row in range(len(x)):
            near = [np.flatnonzero(b[row] <= self.reach2 + 1e-9) for b in borders]
            (n1, n2), (d1, d2) = near, (one[row], two[row])
            n1, n2 = n1[np.argsort(d1[n1], kind="stable")], n2[np.argsort(d2[n2], kind="stable")]
            inside = np.flatnonzero((borders[0][row, n1][:, None] + borders[1][row, n2] <= self.reach2 + 1e-9).ravel())
            if most is None:
                cells = n1[inside // len(n2)] * width + n2[inside % len(n2)]
                out.append(cells[cells >= n1[0] * width + n2[0]].tolist())
            else:
                order = inside[np.argsort((d1[n1][:, None] + d2[n2]).ravel()[inside], kind="stable")[:most]]
                out.append((n1[order // len(n2)] * width + n2[order % len(n2)]).tolist())
        return out


def enough(found: dict[int, float], weight: float, squares: float, whole: bool, recall: float, most: int) -> int | None:
    """Visits that reach the recall. `found` is the weight of the links by their rank, those out of ranks excepted; `squares` is the sum of
    the askers' squared weights. Unless the askers are all rows, an upper limit of the missed share must do (95 %)."""
    if not weight:
        return 1 if whole else None
    size, got = weight * weight / squares, 0.0
    for visits in range(1, most + 1):
        got += found.get(visits, 0.0)
        missed = max(0.0, 1 - got / weight)
        limit = missed if whole else missed + 1.645 * (missed * (1 - missed) / size) ** 0.5 + 3 / size
        if limit <= 1 - recall + 1e-12:
            return visits
    return None


def sampled(rows: DataFrame, dim: int, count: int, most: int, seed: int) -> list:
    """At most about `most` of the `count` rows of a vector length, drawn by hash."""
    some = rows.where(F.col("dim") == dim).select("label", "vector", "row")
    if count > most:
        some = some.where(F.xxhash64("row", F.lit(seed)).bitwiseAND((1 << 30) - 1) < int((1 << 30) * most / count))
    return some.orderBy("row").collect()


def train_grids(rows: DataFrame, cosine: float, recall: float, sample: int, codewords: int | None, values: int = 1 << 22, most: int = 64) -> dict[int, Grid]:
    """A grid for each vector length, fitted on at most about `sample` vectors; its visits by askers of `values` components in all."""
    counts = {r["dim"]: r["count"] for r in rows.groupBy("dim").count().collect()}
    grids, askers = {}, {}
    for dim, count in counts.items():
        held = sampled(rows, dim, count, sample, 0)
        if not held:
            continue
        size = codewords or int(np.clip(np.ceil(np.sqrt(count / 64)), 4, 256))
        grids[dim] = Grid(unit(np.array([r["vector"] for r in held])), size, cosine)
        held = sampled(rows, dim, count, max(1, values // dim), 1)
        asking: dict[str, list] = {}
        for r in held:
            asking.setdefault(r["label"], []).append(r)
        askers[dim] = {label: (unit(np.array([r["vector"] for r in own])), np.array([r["row"] for r in own])) for label, own in asking.items()}
    ranks = rows.mapInArrow(ranked(rows.sparkSession.sparkContext.broadcast((grids, askers)), cosine, most), "dim int, asker long, rank int, n long")
    per = ranks.groupBy("dim", "asker", "rank").agg(F.sum("n").alias("n"))
    per = per.groupBy("dim", "asker").agg(F.sum("n").alias("links"), F.collect_list(F.struct("rank", "n")).alias("ranks"))
    per = per.withColumn("weight", 1 / (F.col("links") + 1)).select("dim", "weight", "links", F.explode("ranks").alias("r"))
    part = F.col("weight") * F.col("r.n") / F.col("links")
    sums = per.groupBy("dim", "r.rank").agg(F.sum(part).alias("found"), F.sum(part * F.col("weight")).alias("squares")).collect()
    for dim, grid in grids.items():
        own = [r for r in sums if r["dim"] == dim]
        whole = counts[dim] <= max(1, values // dim)
        found = {r["rank"]: r["found"] for r in own}
        grid.visits = enough(found, sum(found.values()), sum(r["squares"] for r in own), whole, recall, most)
    return grids


def ranked(shared, cosine: float, most: int):
    """By asker and rank, how many links are found by the cell of that rank, from either end; rank most + 1 is a miss."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids, askers = shared.value
        places: dict[int, dict[int, int]] = {}
        homes = {dim: {label: grids[dim].home(y) for label, (y, _) in own.items()} for dim, own in askers.items()}
        counts: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            labels, dims, vectors, ids = (batch.column(batch.schema.names.index(n)) for n in ("label", "dim", "vector", "row"))
            labels, dims, ids = np.array(labels.to_pylist(), object), np.array(dims.to_pylist()), np.array(ids.to_pylist())
            for dim in np.unique(dims):
                for label in set(labels[dims == dim]):
                    y_all, who_all = askers.get(int(dim), {}).get(label, (None, None))
                    if y_all is None:
                        continue
                    own, grid = np.flatnonzero((dims == dim) & (labels == label)), grids[int(dim)]
                    x_all = unit(np.array(vectors.take(pa.array(own)).to_pylist()))
                    x_homes, x_places = grid.home(x_all), {}
                    for begin in range(0, len(y_all), 1024):
                        y, who, y_homes = (v[begin : begin + 1024] for v in (y_all, who_all, homes[int(dim)][label]))
                        near = y @ x_all.T >= cosine
                        near &= who[:, None] != ids[own]
                        some, others = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
                        if not len(some):
                            continue
                        for new, x, kept in (([i for i in some if who[i] not in places], y, places), ([i for i in others if i not in x_places], x_all, x_places)):
                            for i, cells in zip(new, grid.visited(x[new], most) if new else [], strict=True):
                                kept[who[i] if x is y else i] = {c: r + 1 for r, c in enumerate(cells)}
                        cells, at = np.unique(x_homes[others], return_inverse=True)
                        forth = np.array([[places[who[i]].get(c, most + 1) for c in cells.tolist()] for i in some])[:, at]
                        cells, at = np.unique(y_homes[some], return_inverse=True)
                        back = np.array([[x_places[i].get(c, most + 1) for c in cells.tolist()] for i in others])[:, at].T
                        rank = np.where(near[np.ix_(some, others)], np.minimum(forth, back), 0)
                        for i, row in zip(some, rank, strict=True):
                            key = (int(dim), int(who[i]))
                            counts[key] = counts.get(key, 0) + np.bincount(row, minlength=most + 2)
        out = [(dim, who, r, int(n[r])) for (dim, who), n in counts.items() for r in np.flatnonzero(n[1:]) + 1]
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names=["dim", "asker", "rank", "n"])

    return run


def near_vectors(
    df: DataFrame,
    cosine: float = 0.98,
    recall: float = 0.999,
    sample: int = 20_000,
    codewords: int | None = None,
    block: int = 512,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    values: int = 1 << 22,
) -> DataFrame:
    """vec_id, n_links, component_id and kept (vec_id is component_id) of every row."""
    spark = df.sparkSession
    scratch = Scratch(spark, "vectors")
    rows = scratch.store(usable(df, vec_id, embedding, label).withColumn("row", F.monotonically_increasing_id()), "rows")
    trained = train_grids(rows, cosine, recall, sample, codewords, values)
    halved = [dim for dim, grid in trained.items() if grid.visits is None]
    grids = spark.sparkContext.broadcast(trained)  # codebooks: 256 words a half at most

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, vectors = np.array(batch.column(2).to_pylist()), batch.column(3).to_pylist()
            home, asked = np.full(len(dims), -1, np.int64), [[] for _ in dims]
            for dim in np.unique(dims):
                own, grid = np.flatnonzero(dims == dim), grids.value[int(dim)]
                x = unit(np.array([vectors[i] for i in own]))
                home[own] = grid.home(x)
                for i, found in zip(own, grid.visited(x, grid.visits), strict=True):
                    asked[i] = found
            columns = [*batch.columns, pa.array(home), pa.array(asked, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "home", "asked"])

    placed = scratch.store(
        rows.mapInArrow(cells, "vec_id long, label string, dim int, vector array<double>, row long, home long, asked array<long>"), "placed"
    )
    scratch.drop("rows")
    key = ["label", "dim", "cell"]
    # Blocks a cell has for its vectors and for its askers, so that a group holds about `block` of each.
    asks = placed.withColumn("cell", F.explode("asked"))
    homes = placed.withColumn("cell", F.col("home"))
    blocks = homes.groupBy(*key).agg(F.ceil(F.count("*") / block).cast("int").alias("home_blocks"))
    blocks = blocks.join(asks.groupBy(*key).agg(F.ceil(F.count("*") / block).cast("int").alias("ask_blocks")), key)
    blocks = scratch.store(blocks, "blocks")  # both sides of the joins with it are dealt anew, so Spark splits hot cells
    mine = lambda n: F.pmod(F.xxhash64("row"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    # A held vector brings the cells it asks itself; where all are asked, a pair meets once and none are needed.
    asked = F.when(F.col("dim").isin(halved), F.array().cast("array<long>")).otherwise(F.col("asked"))
    homes, asks = homes.withColumn("asked", asked), asks.withColumn("asked", F.array("home"))
    fields = [*key, "home_block", "ask_block", "kind", "row", "vec_id", "vector", "asked"]
    held = homes.join(blocks, key).withColumn("kind", F.lit(0)).withColumn("home_block", mine("home_blocks")).withColumn("ask_block", every("ask_blocks"))
    asking = asks.join(blocks, key).withColumn("kind", F.lit(1)).withColumn("ask_block", mine("ask_blocks")).withColumn("home_block", every("home_blocks"))
    group = [*key, "home_block", "ask_block"]
    dealt = held.select(*fields).unionByName(asking.select(*fields)).repartition(*group).sortWithinPartitions(*group, "kind")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held_rows = None, []
        for batch in batches:
            names = batch.schema.names
            for *where, kind, row, who, vector, asked in zip(*(batch.column(names.index(f)).to_pylist() for f in fields), strict=True):
                if where != at:
                    if held_rows:
                        yield linked(held_rows, at[2], cosine)
                    at, held_rows = where, []
                held_rows.append((kind, row, who, vector, asked))
        if held_rows:
            yield linked(held_rows, at[2], cosine)

    found = scratch.store(dealt.mapInArrow(compare, REACH), "found")
    counts = found.where("kind = 0").groupBy(F.col("a").alias("row")).agg(F.sum("n").alias("n_links"))
    component = components(found.where("kind = 1").select("a", "b"), scratch)
    linked_rows = placed.select("row", "vec_id").join(counts, "row", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    # Rows that cannot link come back beside the others.
    others = df.where(~can_link(vec_id, embedding, label)).select(F.col(vec_id).alias("vec_id"), F.lit(0).cast("long").alias("n_links"))
    out = linked_rows.unionByName(others)
    out = out.join(component, out["vec_id"] == component["id"], "left")
    return out.select("vec_id", "n_links", F.coalesce("component", "vec_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )


def linked(rows: list[tuple], cell: int, cosine: float) -> pa.RecordBatch:
    """Counts (kind 0: row a has n links) and a spanning forest of the links (kind 1: ids a and b) of one group.

    A link counts for its asker, and for the held vector too unless that one asks the asker's own cell, where it counts it itself.
    """
    home, ask = [r for r in rows if r[0] == 0], [r for r in rows if r[0] == 1]
    out: list[tuple] = []
    if home and ask:
        x, y = (np.array([r[3] for r in side]) for side in (ask, home))
        x, y = (v / np.abs(v).max(axis=1, keepdims=True) for v in (x, y))
        lengths = np.sqrt((x * x).sum(1))[:, None] * np.sqrt((y * y).sum(1))
        near = x @ y.T / lengths >= cosine
        near &= np.array([r[1] for r in ask])[:, None] != np.array([r[1] for r in home])
        counts = near.sum(1)
        out += [(0, int(n), r[1], None) for r, n in zip(ask, counts, strict=True) if n]
        if counts.any():
            origins = np.array([r[4][0] for r in ask])
            back, away = np.zeros(len(home), np.int64), origins != cell
            for j in np.flatnonzero(near[away].any(0)):
                back[j] = (near[away, j] & ~np.isin(origins[away], home[j][4])).sum()
            out += [(0, int(n), r[1], None) for r, n in zip(home, back, strict=True) if n]
            asker, owner = np.array([r[2] for r in ask]), np.array([r[2] for r in home])
            top, over = asker.copy(), owner.copy()
            most = np.iinfo(np.int64).max
            while True:
                up = np.minimum(over, np.where(near, top[:, None], most).min(0))
                down = np.minimum(top, np.where(near, up, most).min(1))
                if (up == over).all() and (down == top).all():
                    break
                top, over = down, up
            out += [(1, None, int(a), int(b)) for ids, tops in ((asker, top), (owner, over)) for a, b in zip(ids, tops, strict=True) if a != b]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names=["kind", "n", "a", "b"])
