"""N-gram Jaccard join by PartEnum signatures, and the components of its links.

A document's set holds its distinct 5-word shingles. Two sets link when 100 |A & B| >= 75 |A | B|; then they differ in at most
(|A| + |B|) / 7 shingles. Pairs are dealt in bands by |A| + |B|, and a set takes part in the two or three bands its partners can put
it in. In a band with at most k differences the shingles' domain is cut into about 1.5 k parts, and each part of a set, hashed,
is a signature. Linked sets agree on all parts but k, so some agreeing parts can be lost and one is still left:

* Empty parts, which unlike sets share, are not signed.
* Signatures that more than `FEW` sets share (parts of passages that many documents quote) are not paired, if the set can lose all
  of those it has. Sets that cannot, because they consist of such parts, are joined among themselves in the limit of
  one-shingle parts: of a set's shingles, rarest first, so many are signatures that a linked set must have one of them.
* The rest pairs the few sets that share it.

Pairs are first held against a lower bound of their difference (parities of their shingles over some cells, a few bytes a
set), then verified in full. Signatures travel packed, 8 bytes each. Groups of the one-shingle join may be large, as copies by the thousand
are: their members form a star around the least, the spokes are verified, and only members that then are in different
components are compared, in blocks, each of which gives no more links than it takes to connect its members. So no link between
components is lost, and no large group is expanded. Equal sets are one node from
the start, and a signature that one batch of texts repeats often is counted there.

Defined cases: a null text is an empty one; texts without words have an empty set, link with nothing and are their own component;
rows that repeat an id, or have none, are documents of their own, and a component is named by its least id that is not null.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caretrail.llm.components import components
from caretrail.llm.stored import Scratch, tidy
from caretrail.llm.words import BASE, SPACES, Words, column_bytes, mixed, slices

SHINGLE = 5
PERCENT = 75
FEW = 8  # sets whose signature pairs them
HOT = 256  # sets of one batch that make a signature hot there
CELLS = 1 << 16  # most cells of a parity sketch


class Sets:
    """Shingle sets of some texts: `hash` and `row` in order of row and hash, `size` and `node` by row."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, shingle: int = SHINGLE):
        words = Words(data, starts, SPACES)
        n = len(starts) - 1
        full = np.flatnonzero(words.whole(shingle))
        hashes, rows = [words.grams(shingle)[full]], [words.row[full]]
        for k in range(1, shingle):  # the whole sequence of a shorter text
            short = np.flatnonzero(words.counts == k)
            if len(short):
                hashes.append(mixed(words.grams(k)[words.first[short]] + np.uint64(k)))
                rows.append(short)
        row, value = np.concatenate(rows), np.concatenate(hashes)
        order = np.lexsort((value, row))
        row, value = row[order], value[order]
        fresh = np.ones(len(row), bool)
        fresh[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
        self.row, self.hash = row[fresh], value[fresh]
        self.size = np.bincount(self.row, minlength=n)
        self.first = np.concatenate([[0], np.cumsum(self.size)])
        total = np.zeros(n, np.uint64)
        np.add.at(total, self.row, mixed(self.hash + BASE))
        self.node = (mixed(total + self.size.astype(np.uint64) * BASE) >> np.uint64(1)).astype(np.int64)

    def of(self, row: int) -> np.ndarray:
        return self.hash[self.first[row] : self.first[row + 1]]


def bands(largest: int, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Upper ends of the bands of |A| + |B|, the most differences in each, and its number of parts."""
    tops = [2]
    while tops[-1] < largest:
        tops.append(max(tops[-1] + 1, tops[-1] * 4 // 3))
    top = np.array(tops)
    most = top * (100 - percent) // (100 + percent)
    return top, most, most + 1 + most // 2 + (most > 1)


@dataclass
class Signed:
    """Signatures with their row, band, and `spare`: of the parts on which a linked set agrees at the least, how many may be lost
    before none is left. Below 0, empty parts are signed as well, and none may be lost."""

    row: np.ndarray
    sign: np.ndarray
    band: np.ndarray
    spare: np.ndarray


def signatures(sets: Sets, percent: int = PERCENT) -> Signed:
    """One signature for each part of each set in its bands; none for sets that only an equal set can link with."""
    size = sets.size
    low, high = size + -(-percent * size // 100), size + 100 * size // percent
    top, most, parts = bands(int(high.max(initial=0)), percent)
    first, last = np.searchsorted(top, low), np.searchsorted(top, high)
    out = []
    for step in range(int((last - first).max(initial=-1)) + 1):
        band = np.minimum(first + step, len(top) - 1)
        takes = (first + step <= last) & (size > 0) & (most[band] > 0)
        if not takes.any():
            continue
        width = np.where(takes, parts[band], 0)
        offset = np.concatenate([[0], np.cumsum(width)])
        inside = takes[sets.row]
        row, value = sets.row[inside], sets.hash[inside]
        salt = band.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)
        spread = mixed(value + salt[row])
        at = offset[row] + ((spread >> np.uint64(32)) * width[row].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        total, filled = np.zeros(offset[-1], np.uint64), np.bincount(at, minlength=offset[-1]) > 0
        np.add.at(total, at, mixed(spread ^ BASE))
        owner = np.repeat(np.arange(len(size)), width)
        number = np.arange(offset[-1]) - offset[owner]
        spare = width - most[band] - 1 - np.bincount(owner[~filled], minlength=len(size))
        signs = filled | (spare < 0)[owner]
        own = owner[signs]
        out.append((own, mixed(total[signs] + salt[own] + mixed(number[signs].astype(np.uint64) + BASE)), band[own], spare[own]))
    if not out:
        return Signed(*(np.zeros(0, t) for t in (np.int64, np.uint64, np.int64, np.int64)))
    return Signed(*(np.concatenate(c) for c in zip(*out, strict=True)))


@dataclass
class Batch:
    """Signatures of some texts in order, each with the index of its set and band in the list of `states`: node, band, spare."""

    sign: np.ndarray
    index: np.ndarray
    states: np.ndarray

    @property
    def name(self) -> int:
        """The same for the same texts, so that a task that is run again gives the same references."""
        each = mixed(self.states.ravel().view(np.uint64) + np.arange(self.states.size, dtype=np.uint64))
        return int(mixed(each.sum(keepdims=True) + BASE)[0]) >> 17


def batches_of(column: pa.Array, shingle: int, percent: int, most: int = 4 << 20) -> Iterator[Batch]:
    """Signatures of a column of texts, some megabytes at a time and copies among them once."""
    data, starts = column_bytes(column)
    for begin, end in slices(starts, most):
        done, signs, indices, states, total = np.zeros(0, np.int64), [], [], [], 0
        for low, high in slices(starts[begin : end + 1]):
            low, high = low + begin, high + begin
            sets = Sets(data[starts[low] : starts[high]], starts[low : high + 1] - starts[low], shingle)
            node, first = np.unique(sets.node, return_index=True)
            once = np.zeros(len(sets.size), bool)
            once[first[~np.isin(node, done)]] = True
            done = np.union1d(done, node)
            signed = signatures(sets, percent)
            keep = once[signed.row]
            state = signed.row[keep] << 32 | signed.band[keep]
            own, at, index = np.unique(state, return_index=True, return_inverse=True)
            signs.append(signed.sign[keep])
            indices.append(index + total)
            states.append(np.stack([sets.node[own >> 32], own & 0xFFFFFFFF, np.maximum(signed.spare[keep][at], -1)], axis=1))
            total += len(own)
        sign, index, table = np.concatenate(signs), np.concatenate(indices), np.concatenate(states)
        order = np.argsort(sign)
        sign, index = sign[order], index[order]
        for at in range(0, len(table), 1 << 16):  # an index has 16 bits
            own = (index >= at) & (index < at + (1 << 16))
            yield Batch(sign[own], index[own] - at, table[at : at + (1 << 16)])


# kind 0: references x and y share a signature with few others; kind 1: x has y signatures that many share; kind 2: x stands for
# the node y in band and spare z.
MET = "kind int, x long, y long, z long"


def _runs(sign: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of some sorted values where its run starts and how long that is."""
    ends = np.flatnonzero(np.r_[sign[1:] != sign[:-1], True]) + 1 if len(sign) else np.zeros(0, np.int64)
    size = np.diff(np.r_[0, ends])
    return np.repeat(ends - size, size), np.repeat(size, size)


def _met(kind: int, *columns: np.ndarray) -> pa.RecordBatch:
    columns = [*columns, *[np.zeros(len(columns[0]), np.int64)] * (3 - len(columns))]
    arrays = [pa.array(np.full(len(columns[0]), kind, np.int32)), *(pa.array(c.astype(np.int64)) for c in columns)]
    return pa.RecordBatch.from_arrays(arrays, names=["kind", "x", "y", "z"])


def meetings(documents: DataFrame, buckets: int, shingle: int, percent: int) -> DataFrame:
    """What the sets share, as `MET` has it; pairs of a bucket once."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        for batch in batches:
            for own in batches_of(batch.column(0), shingle, percent):
                start, size = _runs(own.sign)
                # Of a signature that is hot here some tell its bucket that it is a crowd; the others are counted at once.
                rest = (size > HOT) & (np.arange(len(size)) - start > FEW)
                crowd = np.stack(np.unique(own.index[rest], return_counts=True), axis=1)
                sign, index = own.sign[~rest], own.index[~rest]
                bucket = ((sign >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)  # grows with the signature
                entry = (sign << np.uint64(16)) | index.astype(np.uint64)
                ends = np.searchsorted(bucket, np.arange(buckets + 1))
                rows = []
                for k in range(buckets):
                    table = own.states.tobytes() if k == own.name % buckets else b""
                    counted = crowd[k::buckets].astype(np.int32).tobytes()
                    if table or counted or ends[k + 1] > ends[k]:
                        rows.append((k, own.name, entry[ends[k] : ends[k + 1]].tobytes(), counted, table))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["bucket", "name", "entries", "crowd", "states"])

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            for bucket, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != at:
                    if held:
                        yield from _bucket(held)
                    at, held = bucket, []
                held.append(row)
        if held:
            yield from _bucket(held)

    dealt = documents.select("text").mapInArrow(tidy(packed), "bucket int, name long, entries binary, crowd binary, states binary").repartition(buckets, "bucket")
    return dealt.sortWithinPartitions("bucket").mapInArrow(tidy(met), MET)


def _bucket(held: list[tuple[int, bytes, bytes, bytes]]) -> Iterator[pa.RecordBatch]:
    """Pairs of the signatures of a bucket that few share, and counts of the others by reference."""
    for name, _, counted, table in held:
        if counted:
            crowd = np.frombuffer(counted, np.int32).reshape(-1, 2).astype(np.int64)
            yield _met(1, crowd[:, 0] | name << 16, crowd[:, 1])
        if table:
            state = np.frombuffer(table, np.int64).reshape(-1, 3)
            yield _met(2, np.arange(len(state)) | name << 16, state[:, 0], state[:, 1] << 32 | state[:, 2] + 1)
    entry = np.concatenate([np.frombuffer(e, np.uint64) for _, e, _, _ in held])
    name = np.repeat(np.array([n for n, *_ in held], np.int64), [len(e) // 8 for _, e, _, _ in held])
    order = np.argsort(entry)
    entry = entry[order]
    ref = name[order] << 16 | (entry & np.uint64(0xFFFF)).astype(np.int64)
    start, size = _runs(entry >> np.uint64(16))
    place, few = np.arange(len(size)), (size > 1) & (size <= FEW)
    pairs = [np.zeros((0, 2), np.int64)]
    for step in range(1, FEW):  # each with the one `step` before it
        later = place[few & (place - step >= start)]
        pairs.append(np.stack([ref[later], ref[later - step]], axis=1))
    both = np.concatenate(pairs)
    both.sort(axis=1)
    order = np.lexsort((both[:, 1], both[:, 0]))
    both = both[order]
    fresh = np.ones(len(both), bool)
    fresh[1:] = (both[1:] != both[:-1]).any(axis=1)
    yield _met(0, both[fresh, 0], both[fresh, 1])
    yield _met(1, *np.unique(ref[size > FEW], return_counts=True))


def sketches(sets: Sets) -> list[bytes]:
    """Of each set the parity of the number of its shingles in each of a power of two of cells, four to eight a shingle.

    So few differences fall into one cell that sets a little less similar than asked for are told apart as well.
    """
    cells = np.clip(4 << np.ceil(np.log2(sets.size + 1)).astype(np.int64), 256, CELLS)
    offset = np.concatenate([[0], np.cumsum(cells)])
    at = offset[sets.row] + (mixed(sets.hash) & (cells[sets.row] - 1).astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(at, minlength=offset[-1]) & 1).astype(np.uint8)
    raw = np.packbits(odd, bitorder="little").tobytes()
    return [raw[a // 8 : b // 8] for a, b in zip(offset[:-1].tolist(), offset[1:].tolist(), strict=True)]


def may_link(a: bytes, b: bytes, size_a: int, size_b: int, percent: int) -> bool:
    """False only if the sets cannot link: their sizes, or the cells of odd difference, say so."""
    if 100 * min(size_a, size_b) < percent * max(size_a, size_b):
        return False
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    most = size_a + size_b - 2 * -(-percent * (size_a + size_b) // (100 + percent))
    return int(np.bitwise_count(x ^ y).sum()) <= most


def linked(sets_a: np.ndarray, sets_b: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(sets_a, sets_b, assume_unique=True))
    return 100 * shared >= percent * (len(sets_a) + len(sets_b) - shared)


def sides(pairs: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs with the columns of both nodes, as x_... and y_...; a hot node is a skewed join key, which Spark splits."""
    for side in "xy":
        pairs = pairs.join(table.select(F.col("node").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns]), side)
    return pairs.select("x", "y", *[f"{side}_{c}" for side in "xy" for c in columns])


def possible(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs that the sketches do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, size_x, sketch_x, size_y, sketch_y = (c.to_pylist() for c in batch.columns)
            keep = [may_link(*r, percent) for r in zip(sketch_x, sketch_y, size_x, size_y, strict=True)]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], names=["x", "y"])

    return sides(pairs, texts, ["size", "sketch"]).mapInArrow(tidy(run), "x long, y long")


def verified(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Pairs (x, y) whose sets link, compared in full."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                x, y, px, py = (c.to_pylist() for c in batch.slice(begin, 512).columns)
                if len(known) > 2_000:
                    known.clear()
                need = {n: p for n, p in [*zip(x, px, strict=True), *zip(y, py, strict=True)] if n not in known}
                known.update(zip(need, unpacked_sets(list(need.values()), shingle), strict=True))
                ok = pa.array([linked(known[a], known[b], percent) for a, b in zip(x, y, strict=True)], pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()).filter(ok), pa.array(y, pa.int64()).filter(ok)], names=["x", "y"])

    return sides(possible(pairs, texts, percent), texts, ["packed"]).mapInArrow(tidy(run), "x long, y long")


def unpacked_sets(packed: list[bytes], shingle: int) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    data, starts = column_bytes(pa.array([zlib.decompress(p) for p in packed], pa.binary()))
    for low, high in slices(starts):
        sets = Sets(data[starts[low] : starts[high]], starts[low : high + 1] - starts[low], shingle)
        out += [sets.of(i).copy() for i in range(high - low)]
    return out


def with_nodes(documents: DataFrame, keep: tuple[str, ...], shingle: int) -> DataFrame:
    """The kept columns, `node` (null for an empty set) and `n_shingles`."""
    schema = documents.select(*keep).schema.add("node", "long").add("n_shingles", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = column_bytes(batch.column(len(keep)))
            for low, high in slices(starts):
                sets = Sets(data[starts[low] : starts[high]], starts[low : high + 1] - starts[low], shingle)
                columns = [batch.column(i).slice(low, high - low) for i in range(len(keep))]
                columns += [pa.array(sets.node, pa.int64(), mask=sets.size == 0), pa.array(sets.size.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return documents.select(*keep, F.col("text").alias("__text")).mapInArrow(tidy(run), schema)


def node_texts(documents: DataFrame, shingle: int) -> DataFrame:
    """node, size, sketch and packed text of every text with words, copies of a batch once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = column_bytes(batch.column(0))
            done: set[int] = set()
            for low, high in slices(starts):
                sets = Sets(data[starts[low] : starts[high]], starts[low : high + 1] - starts[low], shingle)
                rows, sketch = [], sketches(sets)
                for i in np.flatnonzero(sets.size).tolist():
                    if (node := int(sets.node[i])) not in done:
                        done.add(node)
                        raw = data[starts[low + i] : starts[low + i + 1]].tobytes()
                        rows.append((node, int(sets.size[i]), sketch[i], zlib.compress(raw, 1)))
                kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
                names = ["node", "size", "sketch", "packed"]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=names)

    return documents.select("text").mapInArrow(tidy(run), "node long, size long, sketch binary, packed binary")


def bucket_count(spark, documents: DataFrame) -> int:
    """Buckets of some 16 MB: signatures take about as many bytes as a text."""
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // (16 << 20)))


def single_shingles(texts: DataFrame, scratch: Scratch, shingle: int, percent: int) -> DataFrame:
    """(sign, node): for each node its rarest shingles, so many that a linked node has one of them among its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                sets = unpacked_sets(part.column(1).to_pylist(), shingle)
                size = np.array([len(v) for v in sets], np.int64)
                columns = [np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64), np.repeat(np.array(part.column(0).to_pylist(), np.int64), size), np.repeat(size, size)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["sign", "node", "size"])

    own = scratch.store(texts.select("node", "packed").mapInArrow(tidy(run), "sign long, node long, size long"), "shingles")
    common = scratch.store(own.groupBy("sign").agg(F.count("*").alias("n")).where("n > 1"), "common")
    # A shingle of one node pairs nothing and stands before all shared ones, so counting from the frequent end skips it.
    shared = own.join(common, "sign")
    rank = Window.partitionBy("node").orderBy(F.col("n").desc(), F.col("sign").desc())
    ranked = shared.withColumn("from_top", F.row_number().over(rank))
    # The most frequent shingles of a node, one less than a linked node must share, are left out.
    return ranked.where(F.expr(f"from_top > (({percent} * size + 99) div 100) - 1")).select("sign", "node")


def star_links(group: DataFrame, texts: DataFrame, scratch: Scratch, shingle: int, percent: int) -> DataFrame:
    """Links that connect what the members of each sign, however many, are connected by.

    What is counted by sign is stored before it is joined: both sides are then dealt anew, and Spark splits hot signs.
    """
    # Of signs with the same members, as the shingles of a passage have, one says what all say.
    marks = [F.bit_xor(F.xxhash64("node", F.lit(seed))).alias(f"mark_{seed}") for seed in (1, 2)]
    lists = group.groupBy("sign").agg(F.count("*").alias("n"), *marks).where("n > 1")
    one = scratch.store(lists.groupBy("n", "mark_1", "mark_2").agg(F.min("sign").alias("sign")).select("sign"), "signs")
    group = scratch.store(group.join(one, "sign", "left_semi"), "lists")
    centre = scratch.store(group.groupBy("sign").agg(F.min("node").alias("y")), "centres")
    spoke = group.join(centre, "sign").select(F.col("node").alias("x"), "y").where("x <> y").distinct()
    first = scratch.store(verified(spoke, texts, shingle, percent), "spokes")
    component = components(first.select(F.col("x").alias("a"), F.col("y").alias("b")), scratch, "stars")
    named = group.join(component, group["node"] == component["id"], "left").select("sign", "node", F.coalesce("component", "node").alias("component"))
    named = scratch.store(named, "named")
    apart = named.groupBy("sign").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("sign")
    named = scratch.store(named.join(scratch.store(apart, "apart"), "sign", "left_semi"), "mixed")
    return first.unionByName(scratch.store(apart_links(named, texts, scratch, shingle, percent), "apart-links"))


CELL, KINDS = ["sign", "low", "high"], [pa.int64(), pa.int32(), pa.int32()]


def apart_links(
    named: DataFrame, texts: DataFrame, scratch: Scratch, shingle: int, percent: int, block: int = 1_024, block_bytes: int = 4 << 20
) -> DataFrame:
    """Links that connect the members of a sign that are linked but in different components.

    A large sign is dealt in blocks, by number and bytes of its members, and each two of its blocks are compared in one task: by sketches
    first, which tell the members that may have a link there, and then those members in full. A task gives fewer links than it has
    members: a pair that it has connected already is not compared.
    """
    length = texts.select("node", F.length("packed").alias("bytes"))
    size = named.join(length, "node").groupBy("sign").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    blocks = scratch.store(size.select("sign", F.ceil(F.greatest(F.col("n") / block, F.col("bytes") / block_bytes)).cast("int").alias("blocks")), "blocks")
    signs = named.groupBy("node").agg(F.collect_set("sign").alias("signs"))  # fewer than the node has shingles
    rows = named.join(texts.select("node", "size", "sketch").join(signs, "node"), "node").join(blocks, "sign")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int")).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    rows = rows.select("sign", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node", "component", "size", "sketch", "signs")

    def by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
        at, held = None, []
        for batch in batches:
            for *where, own, node, component, size, sketch, signs, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if where != at:
                    if len(held) > 1:
                        yield at, held
                    at, held = where, []
                held.append((own, node, component, size, sketch, signs, packed))
        if len(held) > 1:
            yield at, held

    def may(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, held in by_cell(batches):
            places = np.unique(_candidates(cell, held, percent)[0])
            nodes = pa.array([held[i][1] for i in places.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*(pa.array([v] * len(nodes), t) for v, t in zip(cell, KINDS, strict=True)), nodes], names=[*CELL, "node"])

    def connected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, held in by_cell(batches):
            yield _connected(cell, held, shingle, percent)

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition(*CELL).sortWithinPartitions(*CELL)

    near = dealt(rows.withColumn("packed", F.lit(None).cast("binary"))).mapInArrow(tidy(may), "sign long, low int, high int, node long")
    near = scratch.store(near, "near")
    own = named.join(signs, "node").join(blocks, "sign").select("sign", "node", "component", "signs", F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("own"))
    full = near.join(own, ["sign", "node"]).join(texts, "node").select(*CELL, "own", "node", "component", "size", "sketch", "signs", "packed")
    return dealt(full).mapInArrow(tidy(connected), "x long, y long").distinct()


def _connected(cell: list, rows: list[tuple], shingle: int, percent: int) -> pa.RecordBatch:
    """Links between members of a cell, as many as connect what is linked there, likest first."""
    pairs, unlike = _candidates(cell, rows, percent)
    wanted = np.unique(pairs)
    sets = dict(zip(wanted.tolist(), unpacked_sets([rows[i][6] for i in wanted.tolist()], shingle), strict=True)) if len(wanted) else {}
    tree: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := tree.get(top, top)) != top:
            top = up
        while (up := tree.get(x, x)) != top:
            tree[x], x = top, up
        return top

    out = []
    for i, j in pairs[np.argsort(unlike, kind="stable")].tolist():
        a, b = root(rows[i][2]), root(rows[j][2])
        if a != b and linked(sets[i], sets[j], percent):
            tree[a] = b
            out.append((max(rows[i][1], rows[j][1]), min(rows[i][1], rows[j][1])))
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in (0, 1)], names=["x", "y"])


def _candidates(cell: list, rows: list[tuple], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs across the two blocks of a cell, or within its one, that are apart and that the sketches do not rule
    out, and by how many cells their sketches differ."""
    sign, low, high = cell
    signs = [set(r[5]) for r in rows]
    own, component, size = (np.array([r[i] for r in rows], np.int64) for i in (0, 2, 3))
    cells = np.array([len(r[4]) for r in rows])
    pairs, differ = [np.zeros((0, 2), np.int64)], [np.zeros(0, np.int64)]
    for width in np.unique(cells):
        # Sets that may link have as many cells, or twice as many, which are folded.
        near = np.flatnonzero((cells == width) | (cells == 2 * width))
        raw = np.zeros((len(near), width), np.uint8)
        for i, r in enumerate(near.tolist()):
            bits = np.frombuffer(rows[r][4], np.uint8)
            raw[i] = bits if len(bits) == width else bits[:width] ^ bits[width:]
        words = raw.view(np.uint64)
        first = np.flatnonzero((cells[near] == width) & ((own[near] == low) | (low == high)))
        if low != high:
            first = np.union1d(first, np.flatnonzero((cells[near] == width) & (own[near] == high)))
        for i in first.tolist():
            others = np.flatnonzero((component[near] != component[near[i]]) & ((own[near] != own[near[i]]) | (low == high)))
            others = others[(cells[near[others]] != width) | (others > i)]  # a pair of one width from its first member
            a, b = size[near[i]], size[near[others]]
            others = others[100 * np.minimum(a, b) >= percent * np.maximum(a, b)]
            total = a + size[near[others]]
            most = total - 2 * -(-percent * total // (100 + percent))
            unlike = np.bitwise_count(words[others] ^ words[i]).sum(axis=1)
            fit = unlike <= most
            good, unlike = near[others[fit]], unlike[fit]
            # Of the signs that both have, the least is where the pair is made.
            mine = signs[near[i]]
            made = np.array([min(mine & signs[j]) == sign for j in good.tolist()], bool)
            pairs.append(np.stack([np.full(int(made.sum()), near[i]), good[made]], axis=1))
            differ.append(unlike[made].astype(np.int64))
    return np.concatenate(pairs), np.concatenate(differ)


def links(documents: DataFrame, scratch: Scratch, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(id, component) of the nodes of `documents` (column text) that are not the least of their component."""
    met = scratch.store(meetings(documents, bucket_count(documents.sparkSession, documents), shingle, percent), "met")
    state = met.where("kind = 2").select(F.col("x").alias("ref"), F.col("y").alias("node"), F.expr("z >> 32 AS band"), F.expr("(z & 4294967295) - 1 AS spare"))
    pairs = met.where("kind = 0").select("x", "y").distinct()
    for side in "xy":
        named = state.select(F.col("ref").alias(side), F.col("node").alias(f"node_{side}"))
        pairs = pairs.join(named, side)
    pairs = pairs.select(F.greatest("node_x", "node_y").alias("x"), F.least("node_x", "node_y").alias("y")).where("x <> y")
    pairs = scratch.store(pairs.distinct(), "pairs")
    lost = met.where("kind = 1").groupBy(F.col("x").alias("ref")).agg(F.sum("y").alias("lost"))
    crowded = lost.join(state, "ref").groupBy("node", "band").agg(F.sum("lost").alias("lost"), F.min("spare").alias("spare"))
    crowded = scratch.store(crowded.where("lost > spare").select("node").distinct(), "crowded")
    wanted = pairs.select(F.explode(F.array("x", "y")).alias("node")).unionByName(crowded).distinct()
    # Copies meet in the partial aggregation of each task, so a hot text moves once a task.
    texts = node_texts(documents, shingle).groupBy("node").agg(*[F.first(c).alias(c) for c in ("size", "sketch", "packed")])
    texts = scratch.store(texts.join(wanted, "node", "left_semi"), "texts")
    few = scratch.store(verified(pairs, texts, shingle, percent), "few")
    group = scratch.store(single_shingles(texts.join(crowded, "node", "left_semi"), scratch, shingle, percent), "group")
    edges = few.unionByName(star_links(group, texts, scratch, shingle, percent))
    return components(edges.select(F.col("x").alias("a"), F.col("y").alias("b")), scratch, "links")


def document_components(documents: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_shingles, component_id and the kept columns of every row."""
    scratch = Scratch(documents.sparkSession, "ngrams")
    component = links(documents, scratch, shingle, percent)
    rows = scratch.store(with_nodes(documents, ("doc_id", *keep), shingle), "rows")
    rooted = rows.join(component, rows["node"] == component["id"], "left").select(
        "doc_id", "n_shingles", *keep, F.coalesce("component", "node").alias("root")
    )
    least = scratch.store(rooted.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least")), "least")
    return rooted.join(least, "root", "left").select(
        "doc_id", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"), *keep
    )


def one_of_each(documents: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """`documents` with one row of each group: that of the least id, and of rows that repeat it the first by content.

    Rows without an id stay unless their group has one; of a group without ids one row stays. Rows without words all stay.
    The kept rows are marked beside the ids and row hashes, and only then joined to the rows.
    """
    scratch = Scratch(documents.sparkSession, "one-of-each")
    columns = documents.columns
    content = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns])
    rows = documents.withColumn("__row", F.struct(*columns)).select("doc_id", "text", "__row", content.alias("__content"))
    nodes = scratch.store(with_nodes(rows, ("doc_id", "__content"), shingle).select("doc_id", "__content", "node"), "nodes")
    component = links(documents.select("text"), scratch, shingle, percent)
    grouped = nodes.where("node IS NOT NULL").join(component, nodes["node"] == component["id"], "left")
    grouped = grouped.select("doc_id", F.col("__content").alias("content"), F.coalesce("component", "node").alias("root"))
    # Least id, then least content: a fixed-width aggregate each, so the tasks combine copies before they are moved.
    grouped = scratch.store(grouped, "grouped")
    least = scratch.store(grouped.groupBy("root").agg(F.min(F.coalesce("doc_id", F.lit((1 << 63) - 1))).alias("least")), "least")
    first = grouped.join(least, "root").where("coalesce(doc_id, 9223372036854775807) = least")
    first = first.groupBy("root").agg(F.min("content").alias("__content"))
    kept = first.select("__content").distinct()
    empty = nodes.where("node IS NULL").select("__content").distinct()
    marked = rows.join(kept.unionByName(empty).distinct(), "__content", "left_semi")
    # Rows that are equal in every column: one of those with words, all of those without.
    once = marked.join(empty, "__content", "left_anti").dropDuplicates(["__content"])
    every = marked.join(empty, "__content", "left_semi")
    return once.unionByName(every).select("__row.*")
