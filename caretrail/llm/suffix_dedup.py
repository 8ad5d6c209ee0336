"""Suffix-array dedup: every byte that a repeated string of `length` bytes covers is removed.

A window is a string of `length` bytes. Sorting all suffixes of a corpus would move each byte many times, so the sort is sparse: each
window is represented by its least `GRAM`-byte string by hash (its anchor), and equal windows have equal anchors at the
same place. Some one in ninety positions is an anchor, and it stands for a run of windows.

1. Anchors are counted by their string; one that occurs once in the corpus stands for windows that occur once.
2. An anchor whose whole context (all its windows) occurs again as it is makes all of them repeats. Long repeats, the inside of
   copies and passages, are settled so, by a 64-bit hash of the context beside that of the string, and one of each is kept as a witness.
3. The rest, anchors at the ends of repeats, is settled by sorting. The suffixes that start at the anchors of one string are
   ordered by deep-shallow sorting: multikey quicksort, eight bytes a key, to a shallow depth, then a blind trie for each group that still
   has a common prefix. The same is done for the contexts to the left, read backwards. The common prefixes of neighbours in
   both orders tell which windows of which anchors are equal.

A string with very many different contexts (the edge of a passage that many texts quote) is split by what its windows must have in
common: those that reach so far to the left and so far to the right of the anchor are dealt by the content of just that stretch.
Where even that leaves a crowd, it is dealt in parts, and what is unlike within its part is compared across parts by a
hash of the window. Matches never cross texts, a text counts as often as it occurs, and strings are judged on the input.

Defined cases: a null text is an empty one; texts shorter than `length` keep all bytes; repeated rows are documents of their own, so
such a text of `length` bytes or more loses everything; ids may be null. A text is known by its 64-bit hash.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretrail.llm.stored import Scratch, tidy
from caretrail.llm.words import BASE, column_bytes, mixed, prefix_hashes, slices

LENGTH = 200
GRAM = 24
SHALLOW = 4  # keys of eight bytes
PART = 1_024  # contexts of one string that are sorted together


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` values in a row, from block-wise running minima of both directions."""
    n = len(values)
    blocks = -(-n // width)
    held = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    held[:n] = values
    square = held.reshape(blocks, width)
    ahead = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(square, axis=1).ravel()
    return np.minimum(ahead[: n - width + 1], behind[width - 1 : n])


def anchors(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Row, string hash, context hash, first window, number of further windows and place of the anchor in the first window."""
    gram = min(GRAM, length)
    width = length - gram + 1
    size = np.diff(starts)
    if not (size >= length).any():
        return (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3)))
    sums, down = prefix_hashes(data)
    hashes = mixed((sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1])
    bits = np.uint64(max(1, int(len(data)).bit_length()))
    place = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    best = (sliding_min(place, width) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    count = np.maximum(size - length + 1, 0)
    row = np.repeat(np.arange(len(size)), count)
    window = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + starts[:-1][row]
    at = best[window]
    fresh = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (row[1:] != row[:-1])])
    last = np.r_[fresh[1:], len(window)] - 1
    row, at, low, high = row[fresh], at[fresh], window[fresh], window[last]
    context = (sums[high + length] - sums[low]) * down[low]
    shape = ((high - low) << 16 | (at - low)).astype(np.uint64)
    return row, hashes[at], mixed(mixed(context) + shape * BASE), low - starts[row], high - low, at - low


ANCHOR = "k long, c long, tid long, at long"  # at: first window, further windows, place of the anchor, copies in the batch


def packed_at(low, more, place, copies):
    return low << 32 | more << 20 | place << 8 | np.minimum(copies, 255)


def unpacked_at(at: int) -> tuple[int, int, int]:
    return at >> 32, at >> 20 & 0xFFF, at >> 8 & 0xFFF


def find_anchors(texts: DataFrame, length: int) -> DataFrame:
    """Anchors of all texts (tid, text); copies of a batch once, with their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tids, first, copies = np.unique(np.array(batch.column(0).to_pylist(), np.int64), return_index=True, return_counts=True)
            if not len(tids):
                continue
            data, starts = column_bytes(batch.column(1).take(pa.array(first)))
            for low, high in slices(starts):
                row, k, c, window, more, place = anchors(data[starts[low] : starts[high]], starts[low : high + 1] - starts[low], length)
                at = packed_at(window, more, place, copies[low + row])
                columns = [pa.array(x) for x in (k.view(np.int64), c.view(np.int64), tids[low + row], at)]
                yield pa.RecordBatch.from_arrays(columns, names=["k", "c", "tid", "at"])

    return texts.mapInArrow(tidy(run), ANCHOR)


# --- sorting -------------------------------------------------------------------------------------------------------


class BlindTrie:
    """Compact trie that is searched by its branching bytes only; a string meets one stored string in full and is put where they part."""

    def __init__(self):
        self.root = None  # a leaf is a list of indices, an inner node a tuple (depth, children by byte)
        self.text: dict[int, bytes] = {}

    def add(self, index: int, text: bytes) -> None:
        self.text[index] = text
        if self.root is None:
            self.root = [index]
            return
        node = self.root
        while isinstance(node, tuple):
            depth, children = node
            node = children.get(text[depth]) or next(iter(children.values()))
        other = self.text[node[0]]
        if text == other:
            node.append(index)
            return
        low, high = 0, len(text)  # where they part, by halving
        while high - low > 1:
            middle = (low + high) // 2
            if text[low:middle] == other[low:middle]:
                low = middle
            else:
                high = middle
        parent, node = None, self.root
        while isinstance(node, tuple) and node[0] < low:
            parent, node = node, node[1][text[node[0]]]
        if isinstance(node, tuple) and node[0] == low:
            node[1][text[low]] = [index]
            return
        fresh = (low, {other[low]: node, text[low]: [index]})
        if parent is None:
            self.root = fresh
        else:
            parent[1][text[parent[0]]] = fresh

    def order(self) -> list[int]:
        out, work = [], [self.root] if self.root is not None else []
        while work:
            node = work.pop()
            if isinstance(node, tuple):
                work += [node[1][b] for b in sorted(node[1], reverse=True)]
            else:
                out += node
        return out


def deep_shallow(group: np.ndarray, texts: np.ndarray, shallow: int = SHALLOW) -> np.ndarray:
    """Order of the rows of `texts` (bytes, equally long) by group, then content.

    Shallow: multikey quicksort on keys of eight bytes; all groups that are still equal are split by their next key at once. Deep: each
    group that is equal to the shallow depth goes through a blind trie.
    """
    n, width = texts.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = texts
    keys = padded.view(">u8").astype(np.uint64)
    order = np.lexsort((keys[:, 0], group))
    tied = np.zeros(n, bool)
    tied[1:] = (group[order[1:]] == group[order[:-1]]) & (keys[order[1:], 0] == keys[order[:-1], 0])
    for depth in range(1, min(shallow, keys.shape[1])):
        inside = tied | np.r_[tied[1:], False]
        at = np.flatnonzero(inside)
        if not len(at):
            return order
        run = np.cumsum(~tied)[at]
        rows = order[at]
        key = keys[rows, depth]
        split = np.lexsort((key, run))
        order[at] = rows[split]
        run, key = run[split], key[split]
        tied[at] = np.r_[False, (run[1:] == run[:-1]) & (key[1:] == key[:-1])]
    begin = np.flatnonzero(~tied & np.r_[tied[1:], False])
    end = np.flatnonzero(tied & ~np.r_[tied[1:], False]) + 1
    for a, b in zip(begin.tolist(), end.tolist(), strict=True):
        trie = BlindTrie()
        for i in order[a:b].tolist():
            trie.add(i, texts[i].tobytes())
        order[a:b] = trie.order()
    return order


def neighbours(group: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order, and the common prefix of each row with the one before it (-1 where the group changes)."""
    order = deep_shallow(group, texts)
    common = np.full(len(order), -1, np.int64)
    unlike = texts[order[1:]] != texts[order[:-1]]
    common[1:] = np.where(unlike.any(axis=1), unlike.argmax(axis=1), texts.shape[1])
    common[1:][group[order[1:]] != group[order[:-1]]] = -1
    return order, common


def classes(order: np.ndarray, common: np.ndarray, depth: int) -> np.ndarray:
    """Number of the class of each row, rows of a class being equal up to the depth."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(common < depth)
    return out


def repeated(group: np.ndarray, left: np.ndarray, right: np.ndarray, nearest: np.ndarray, farthest: np.ndarray, length: int):
    """For each distance of a window's start before the anchor: rows that have such a window, and the class of each window."""
    sorted_left, sorted_right = neighbours(group, left), neighbours(group, right)
    for distance in range(int(nearest.min(initial=0)), int(farthest.max(initial=-1)) + 1):
        rows = np.flatnonzero((nearest <= distance) & (distance <= farthest))
        if len(rows):
            a, b = classes(*sorted_left, distance)[rows], classes(*sorted_right, length - distance)[rows]
            _, number, count = np.unique(a * (len(group) + 1) + b, return_inverse=True, return_counts=True)
            yield distance, rows, number, count


# --- the job -------------------------------------------------------------------------------------------------------

CONTEXT = "k long, tid long, place long, nearest int, farthest int, asks boolean, start long, context binary"
SORTED = "k long, part int, parts int, tid long, place long, nearest int, farthest int, asks boolean, start long, context binary"
FLAG = "kind int, tid long, low long, high long, mark long, mark2 long, single boolean"


def stretches(reach: int) -> list[tuple[int, int]]:
    """Ranges of a window's distance before the anchor, narrow at both ends."""
    cuts = sorted({0, reach // 22, reach * 2 // 11, reach // 2, reach - reach * 2 // 11, reach - reach // 22, reach + 1})
    return [(a, b - 1) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def context_rows(state, tid: int, raw: bytes, length: int) -> Iterator[tuple]:
    """The context of an anchor, whole, or for a string with a crowd of contexts by stretches, keyed by what windows of a stretch share."""
    low, more, place = unpacked_at(state["at"])
    asks, at = state["kind"] == 1, low + place
    if not state["wide"]:
        yield state["k"], tid, at, place - more, place, asks, low, raw[low : low + more + length]
        return
    for a, b in stretches(length - min(GRAM, length)):
        nearest, farthest = max(a, place - more), min(b, place)
        if nearest <= farthest:
            shared = raw[at - a : at + length - b]
            mark = hashlib.blake2b(shared, digest_size=8, key=f"{state['k']} {a}".encode()).digest()
            begin = at - farthest
            yield int.from_bytes(mark, "big", signed=True), tid, at, nearest, farthest, asks, begin, raw[begin : at - nearest + length]


def settle(rows: list[tuple], length: int) -> pa.RecordBatch:
    """Windows of askers that repeat within their part (kind 1), and for strings in several parts each class of windows (kind 2)."""
    reach = length - min(GRAM, length)
    left, right = np.zeros((len(rows), max(1, reach)), np.uint8), np.zeros((len(rows), length), np.uint8)
    for i, (_, _, _, _, place, _, _, _, start, context) in enumerate(rows):
        raw = np.frombuffer(context, np.uint8)
        before, after = raw[: place - start][::-1][:reach], raw[place - start :][:length]
        left[i, : len(before)], right[i, : len(after)] = before, after
    k, part, parts, tid, place, nearest, farthest, asks = (np.array([r[c] for r in rows]) for c in range(8))
    group = np.cumsum(np.r_[True, (k[1:] != k[:-1]) | (part[1:] != part[:-1])])
    flagged, marks = [], []
    for distance, own, number, count in repeated(group, left, right, nearest, farthest, length):
        again = own[(count[number] > 1) & asks[own]]
        flagged.append(np.stack([tid[again], place[again] - distance], axis=1))
        split = own[parts[own] > 1]
        if len(split):  # one of each class, and whether it is an asker that is alone
            numbers = number[parts[own] > 1]
            _, first = np.unique(numbers, return_index=True)
            for i, n in zip(split[first].tolist(), numbers[first].tolist(), strict=True):
                raw = rows[i][9]
                begin = int(place[i] - rows[i][8]) - distance
                mark = hashlib.blake2b(raw[begin : begin + length], digest_size=16).digest()
                marks.append((int(tid[i]), int(place[i]) - distance, int.from_bytes(mark[:8], "big", signed=True), int.from_bytes(mark[8:], "big", signed=True), bool(count[n] == 1 and asks[i])))
    found = np.unique(np.concatenate(flagged), axis=0) if flagged else np.zeros((0, 2), np.int64)
    fresh = np.flatnonzero(np.r_[True, (found[1:, 0] != found[:-1, 0]) | (found[1:, 1] != found[:-1, 1] + 1)]) if len(found) else np.zeros(0, np.int64)
    last = np.r_[fresh[1:], len(found)] - 1 if len(found) else fresh
    n, m = len(fresh), len(marks)
    columns = [
        pa.array(np.repeat(np.array([1, 2], np.int32), [n, m])),
        pa.array([*found[fresh, 0].tolist(), *(x[0] for x in marks)], pa.int64()),
        pa.array([*found[fresh, 1].tolist(), *(x[1] for x in marks)], pa.int64()),
        pa.array([*found[last, 1].tolist(), *(x[1] for x in marks)], pa.int64()),
        pa.array([0] * n + [x[2] for x in marks], pa.int64()),
        pa.array([0] * n + [x[3] for x in marks], pa.int64()),
        pa.array([False] * n + [x[4] for x in marks], pa.bool_()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in FLAG.split(", ")])


def settled(contexts: DataFrame, length: int, at_once: int = 16_384) -> DataFrame:
    """The flags of all contexts, a few whole parts at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if len(held) >= at_once and row[:2] != held[-1][:2]:
                    yield settle(held, length)
                    held = []
                held.append(row)
        if held:
            yield settle(held, length)

    return contexts.repartition("k", "part").sortWithinPartitions("k", "part").mapInArrow(tidy(run), FLAG)


def merged(ranges: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by windows that start in the given ranges."""
    out: list[list[int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high + length)
        else:
            out.append([low, high + length])
    return [(a, b) for a, b in out]


def kept_bytes(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    parts, done = [], 0
    for a, b in runs:
        parts.append(raw[done:a])
        done = b
    return b"".join([*parts, raw[done:]])


RESULT = "tid long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _cut(rows: Iterator[tuple[int, bytes, list[tuple[int, int]]]], length: int, with_text: bool) -> pa.RecordBatch:
    out = []
    for tid, raw, ranges in rows:
        runs = merged(ranges, length)
        kept = kept_bytes(raw, runs)
        out.append((tid, len(raw), len(raw) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), zlib.compress(kept, 1) if with_text else None))
    kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names=[f.split()[0] for f in RESULT.split(", ")])


def _whole_texts(texts: DataFrame) -> DataFrame:
    """(tid, packed) of each distinct text: copies meet in the partial aggregation of each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = column_bytes(batch.column(1))
            packed = [zlib.compress(data[a:b].tobytes(), 1) for a, b in zip(starts[:-1], starts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["tid", "packed"])

    return texts.mapInArrow(tidy(run), "tid long, packed binary").groupBy("tid").agg(F.first("packed").alias("packed"))


def remove_repeats(documents: DataFrame, length: int = LENGTH, text: str = "text", with_text: bool = False) -> DataFrame:
    """By distinct text (tid: its xxhash64): n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the kept bytes (zlib)."""
    scratch = Scratch(documents.sparkSession, "suffixes")
    texts = documents.select(F.coalesce(F.col(text), F.lit("")).alias("text")).select(F.xxhash64("text").alias("tid"), "text")
    copies = F.col("at").bitwiseAND(255)
    found = find_anchors(texts, length)
    # Strings that occur again; `same`: always in the same context.
    again = found.select("k", "c", copies.alias("n")).groupBy("k").agg(F.sum("n").alias("n"), F.min("c").alias("low"), F.max("c").alias("high"))
    again = again.where("n > 1").select("k", (F.col("low") == F.col("high")).alias("same"))
    again = scratch.store(again, "again")  # as a table of its own both sides of the join are dealt anew, so Spark splits hot strings
    held = scratch.store(found.join(again, "k"), "anchors")
    several = held.where("NOT same")
    context = several.groupBy("k", "c").agg(F.sum(copies).alias("n"), F.min(F.struct("tid", "at")).alias("one"))
    context = scratch.store(context.select("k", "c", "n", "one.tid", "one.at"), "contexts")
    whole = held.where("same").select("tid", "at").unionByName(several.join(context.where("n > 1").select("k", "c"), ["k", "c"]).select("tid", "at"))
    crowd = context.groupBy("k").agg((F.count("*") > PART).alias("wide"))
    sorted_out = context.join(crowd, "k").select("tid", "at", "k", "wide", F.when(F.col("n") > 1, 2).otherwise(1).alias("kind"))
    settled_whole = whole.withColumn("at", F.col("at").bitwiseAND(~255)).distinct()
    states = settled_whole.select("tid", "at", F.lit(0).cast("long").alias("k"), F.lit(False).alias("wide"), F.lit(0).alias("kind"))
    states = states.unionByName(sorted_out).groupBy("tid").agg(F.collect_list(F.struct("kind", "at", "k", "wide")).alias("states"))  # those of one text
    pending = scratch.store(_whole_texts(texts).join(states, "tid", "left"), "texts")
    scratch.drop("anchors")

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in CONTEXT.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.binary()]
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                rows = []
                for tid, packed, own in zip(*(c.to_pylist() for c in batch.slice(begin, 256).columns), strict=True):
                    raw = zlib.decompress(packed)
                    for s in own:
                        if s["kind"]:
                            rows += context_rows(s, tid, raw, length)
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=names)

    asked = pending.where(F.exists("states", lambda s: s["kind"] > 0))
    dealt = scratch.store(asked.select("tid", "packed", "states").mapInArrow(tidy(contexts), CONTEXT), "dealt")
    crowd = dealt.groupBy("k").agg(F.count("*").alias("n")).where("n > 1").select("k", F.ceil(F.col("n") / PART).cast("int").alias("parts"))
    dealt = dealt.join(crowd, "k").withColumn("part", F.pmod(F.xxhash64("tid", "place"), "parts").cast("int"))
    flags = scratch.store(settled(dealt.select(*[f.split()[0] for f in SORTED.split(", ")]), length), "flags")
    across = flags.where("kind = 2")
    twice = across.groupBy("mark", "mark2").agg(F.count("*").alias("n")).where("n > 1").select("mark", "mark2")
    across = across.where("single").join(twice, ["mark", "mark2"]).select("tid", "low", "high")
    ranges = flags.where("kind = 1").select("tid", "low", "high").unionByName(across)
    ranges = ranges.groupBy("tid").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))  # those of one text

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of(tid, packed, states, ranges):
            own = [(r["low"], r["high"]) for r in ranges or ()]
            for s in states or ():
                if s["kind"] == 0:
                    low, more, _ = unpacked_at(s["at"])
                    own.append((low, low + more))
            return tid, zlib.decompress(packed), own

        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                yield _cut((of(*r) for r in zip(*(c.to_pylist() for c in batch.slice(begin, 256).columns), strict=True)), length, with_text)

    asks = F.exists("states", lambda s: s["kind"] == 1)
    simple = pending.where(~F.coalesce(asks, F.lit(False))).withColumn("ranges", F.lit(None).cast("array<struct<low:long,high:long>>"))
    other = pending.where(asks).join(ranges, "tid", "left")
    return simple.unionByName(other).select("tid", "packed", "states", "ranges").mapInArrow(tidy(cut), RESULT)


def suffix_digest(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row. A hot text is a skewed join key, which Spark splits."""
    rows = documents.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tid"))
    return rows.join(remove_repeats(documents, length).drop("kept"), "tid").drop("tid")
