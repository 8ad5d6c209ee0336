"""Benchmark decontamination: edit distance to benchmark items, by CGK embedding, bit-sampling LSH and exact verification.

Words are runs of letters and digits, lower-cased. A text is contaminated by an item of m words if some stretch of it is within
`max_edits` * m word edits of the item (inserted, lost and changed words). Every whole text is searched in its own task, so
nothing is shuffled and no group of copies meets in one task:

1. Windows. A stretch within the distance shares a run of q words with the item (q-gram lemma; q is 3, less for items
   of a few words), so only windows of the item's size that are aligned on a shared run can match.
2. Embedding. A CGK random walk reads the words of a window: in step j it writes the word under it and moves on if a random
   bit of (j, word) says so. Windows that are few edits apart fall into step again, so edits become mismatches.
3. Bit sampling. A window and an item collide if they agree in a few sampled steps of a walk; walks are repeated until
   edited copies of the items themselves, planted in other text, reach the target recall.
4. Verification. Colliding windows are compared with the item by exact word edit distance, free of cost at both ends.

Items are taken in blocks of `block` (their grams go to all tasks), whatever the size of the benchmark. Defined cases: null and empty
texts match nothing, items without words contaminate nothing, ids may be null or repeated; each row is its own document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from caretrail.llm.stored import small_batches, tidy
from caretrail.llm.words import PLAIN, Words, column_bytes, mixed, slices

STEPS = 3  # walk length in words of the window
SAMPLED = 3  # steps that must agree


def edits_of(words: int, max_edits: float) -> int:
    return int(words * max_edits + 1e-9)


def gram_of(words: int, edits: int) -> int:
    """The longest run, up to 3 words, that a match must share."""
    return next(q for q in (3, 2, 1) if words - q + 1 - q * edits >= 1 or q == 1)


def sampled_steps(m: int, seed: int) -> np.ndarray:
    return np.sort(np.random.default_rng(seed * 7919 + m).choice(STEPS * m, min(SAMPLED, STEPS * m), replace=False))


def walk(windows: np.ndarray, sizes: np.ndarray, seed: int) -> np.ndarray:
    """Keys of windows, rows of word hashes of the given sizes (0: no word): what a CGK walk writes in the steps sampled
    for a window of that size, hashed together."""
    n, longest = windows.shape
    own, which = np.unique(sizes, return_inverse=True)
    steps = STEPS * int(sizes.max(initial=0))
    sampled = np.zeros((len(own), steps), bool)
    for i, m in enumerate(own.tolist()):
        sampled[i, sampled_steps(m, seed)] = True
    place, key = np.zeros(n, np.int64), np.full(n, seed + 1, np.uint64)
    padded, rows = np.hstack([windows, np.zeros((n, 1), np.uint64)]), np.arange(n)
    for step in range(steps):
        word = padded[rows, place]
        written = sampled[which, step]
        if written.any():
            key[written] = mixed(key[written] * np.uint64(0x9E3779B97F4A7C15) + word[written])
        bit = mixed(word + np.uint64((seed * 0x1000193 + step * 0x85EBCA6B + 1) & 0xFFFFFFFFFFFFFFFF)) & np.uint64(1)
        place = np.minimum(place + bit.astype(np.int64), longest)
    return key


@dataclass
class Item:
    id: int | None
    words: np.ndarray
    edits: int
    q: int


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Fewest word edits between the item and a stretch of the text, and that stretch (first of the shortest)."""
    cost, begin = [0] * (len(text) + 1), list(range(len(text) + 1))
    for i, word in enumerate(item.tolist(), 1):
        last, origin = cost[0], begin[0]
        cost[0] = i
        for j, other in enumerate(text.tolist(), 1):
            best, where = last + (word != other), origin
            last, origin = cost[j], begin[j]
            if last + 1 < best:
                best, where = last + 1, origin
            if cost[j - 1] + 1 < best:
                best, where = cost[j - 1] + 1, begin[j - 1]
            cost[j], begin[j] = best, where
    end = min(range(len(cost)), key=lambda j: (cost[j], j))
    return cost[end], begin[end], end


class Benchmark:
    """Items with their grams and walk keys; `find` gives the matches in a batch of texts."""

    def __init__(self, items: list[tuple[int | None, np.ndarray]], max_edits: float = 0.2, recall: float = 0.99, most_walks: int = 64):
        self.items = []
        for item_id, words in items:
            if len(words):
                edits = edits_of(len(words), max_edits)
                self.items.append(Item(item_id, words, edits, gram_of(len(words), edits)))
        self.sizes = np.array([len(i.words) for i in self.items], np.int64)
        self.edits = np.array([i.edits for i in self.items], np.int64)
        self.longest = int(self.sizes.max(initial=1))
        rows = np.zeros((len(self.items), self.longest), np.uint64)
        for row, item in zip(rows, self.items, strict=True):
            row[: len(item.words)] = item.words
        self.grams: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for q in {i.q for i in self.items}:
            found = sorted((g, k, at) for k, i in enumerate(self.items) if i.q == q for at, g in enumerate(grams_of(i.words, q).tolist()))
            self.grams[q] = tuple(np.array([f[c] for f in found], kind) for c, kind in ((0, np.uint64), (1, np.int64), (2, np.int64)))
        self.bits = {}
        for q, (grams, _, _) in self.grams.items():
            self.bits[q] = np.zeros(1 << 20, bool)
            self.bits[q][(grams >> np.uint64(44)).astype(np.int64)] = True
        self.walks = most_walks
        self.keys = self.keys_of(rows, self.sizes)
        self.walks = self._enough_walks(recall)
        self.keys = self.keys[:, : self.walks]

    def keys_of(self, windows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return np.stack([walk(windows, sizes, seed) for seed in range(self.walks)], axis=1)

    def _enough_walks(self, recall: float) -> int:
        """Walks after which the target share of edited copies collides in each class of sizes (a doubling each); each copy has as many
        edits as an item may have and stands in other text. Items of a class that does not reach it are marked as exact."""
        self.exact = np.zeros(len(self.items), bool)
        if not self.items:
            return 1
        dice, texts = np.random.default_rng(5), []
        classes = np.array([int(n).bit_length() for n in self.sizes])
        picks = [np.resize(dice.permutation(np.flatnonzero(classes == c)), 200) for c in np.unique(classes)]
        chosen = [self.items[i] for i in np.concatenate(picks)]
        for item in chosen:
            edited = item.words.tolist()
            for _ in range(item.edits):
                at, kind = int(dice.integers(len(edited))), int(dice.integers(3))
                edited[at : at + (kind < 2)] = [] if kind == 0 else [int(dice.integers(1 << 62))]
            pad = [int(x) for x in dice.integers(1 << 62, size=2 * len(item.words))]
            texts.append(np.array([*pad, *edited, *pad], np.uint64))
        counts = np.array([len(t) for t in texts])
        words = Words.__new__(Words)
        words.hash, words.row = np.concatenate(texts), np.repeat(np.arange(len(texts)), counts)
        words.first = np.concatenate([[0], np.cumsum(counts)])
        item, begin, row = self._windows(words)
        at = {id(i): k for k, i in enumerate(self.items)}
        own = np.array([at[id(i)] for i in chosen])[row] == item
        item, begin, row = item[own], begin[own], row[own]
        windows = window_rows(words.hash, begin, words.first[row], words.first[row + 1], self.sizes[item], self.longest)
        equal = self.keys_of(windows, self.sizes[item]) == self.keys[item]
        first = np.full(len(texts), np.inf)
        np.minimum.at(first, row, np.where(equal.any(axis=1), equal.argmax(axis=1) + 1, np.inf))
        walks = 1
        for c, found in zip(np.unique(classes), first.reshape(len(picks), -1), strict=True):
            need = np.sort(found)[min(len(found) - 1, int(np.ceil(recall * (len(found) - 1))))]
            if np.isinf(need):
                self.exact[classes == c] = True
            else:
                walks = max(walks, int(need))
        return walks

    def _windows(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item, first word and row of the windows that are aligned on a shared run and have, within the edits around them, as many
        shared runs as a match must have."""
        out = []
        for q, (grams, items, at) in self.grams.items():
            own = words.grams(q)
            near = np.flatnonzero(self.bits[q][(own >> np.uint64(44)).astype(np.int64)] & words.whole(q))
            left, right = np.searchsorted(grams, own[near], "left"), np.searchsorted(grams, own[near], "right")
            count = right - left
            text_at = np.repeat(near, count)
            pick = np.repeat(left - np.cumsum(count) + count, count) + np.arange(count.sum())
            item, begin, row = items[pick], text_at - at[pick], words.row[text_at]
            # Places in the text with a run of the item, in order of item and place.
            width = len(words.hash) + 2 * self.longest + 2
            places = np.unique(item * width + text_at)
            size, edits = self.sizes[item], self.edits[item]
            low, high = (np.clip(x, 0, width - 1) for x in (begin - edits, begin + size + edits))
            shared = np.searchsorted(places, item * width + high) - np.searchsorted(places, item * width + low)
            enough = shared >= np.maximum(1, size - q + 1 - q * edits)
            found = np.unique(np.stack([item[enough], begin[enough], row[enough]]), axis=1)
            out.append(found)
        return tuple(np.concatenate(out, axis=1)) if out else (np.zeros(0, np.int64),) * 3

    def find(self, column: pa.Array) -> dict[int, dict[int, tuple[int, int, int]]]:
        """By row and item: fewest edits, and the bytes of the text from and to which they hold."""
        data, starts = column_bytes(column)
        out: dict[int, dict[int, tuple[int, int, int]]] = {}
        known: dict[tuple[int, bytes], tuple[int, int, int]] = {}
        for low, high in slices(starts) if self.items else ():
            words = Words(data[starts[low] : starts[high]], starts[low : high + 1] - starts[low], PLAIN)
            item, begin, row = self._windows(words)
            for part in np.array_split(np.arange(len(item)), len(item) // 20_000 + 1):
                k, s, r = item[part], begin[part], row[part]
                windows = window_rows(words.hash, s, words.first[r], words.first[r + 1], self.sizes[k], self.longest)
                hit = self.exact[k] | (self.keys_of(windows, self.sizes[k]) == self.keys[k]).any(axis=1)
                for k, s, r in zip(k[hit].tolist(), s[hit].tolist(), r[hit].tolist(), strict=True):
                    found = self._verified(words, k, s, r, known)
                    if found:
                        mine = out.setdefault(low + r, {})
                        mine[k] = min(mine.get(k, found), found)
        return out

    def _verified(self, words: Words, k: int, begin: int, row: int, known: dict) -> tuple[int, int, int] | None:
        item = self.items[k]
        a = max(int(words.first[row]), begin - item.edits)
        b = min(int(words.first[row + 1]), begin + len(item.words) + item.edits)
        region = words.hash[a:b]
        mark = (k, region.tobytes())
        if mark not in known:
            known[mark] = align(item.words, region)
        cost, left, right = known[mark]
        if cost > item.edits or right <= left:
            return None
        text = words.text_start[row]
        return cost, int(words.start[a + left] - text), int(words.end[a + right - 1] - text)


def grams_of(words: np.ndarray, q: int) -> np.ndarray:
    holder = Words.__new__(Words)
    holder.hash = words
    return holder.grams(q)


def window_rows(hashes: np.ndarray, begin: np.ndarray, low: np.ndarray, high: np.ndarray, sizes: np.ndarray, longest: int) -> np.ndarray:
    """Windows of the given sizes as rows; places past the size or outside the text (low to high) are 0."""
    step = np.arange(longest)
    at = begin[:, None] + step
    inside = (at >= low[:, None]) & (at < high[:, None]) & (step < sizes[:, None])
    return np.where(inside, hashes[np.clip(at, 0, max(0, len(hashes) - 1))], np.uint64(0))


def item_blocks(benchmark: DataFrame, block: int) -> Iterator[list[tuple[int | None, np.ndarray]]]:
    """Items with their words, a block of at most `block` at a time. Items of equal text are one for the search."""
    held: list = []
    for r in benchmark.select("item_id", "text").orderBy("item_id").toLocalIterator():
        column = pa.array([r.text or ""])
        data, starts = column_bytes(column)
        held.append((r.item_id, Words(data, starts, PLAIN).hash))
        if len(held) == block:
            yield held
            held = []
    yield held


def leaks(documents: DataFrame, benchmark: DataFrame, max_edits: float = 0.2, recall: float = 0.99, block: int = 20_000) -> DataFrame:
    """A row for each document and item found in it: doc_id, item_id, edits, item_words, start and end (bytes of the text)."""
    small_batches(documents.sparkSession)
    schema = "doc_id long, item_id long, edits int, item_words int, start long, end long"
    out = None
    for items in item_blocks(benchmark, block):
        shared = documents.sparkSession.sparkContext.broadcast(Benchmark(items, max_edits, recall))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            bench = shared.value
            for batch in batches:
                ids, rows = batch.column(0).to_pylist(), []
                for row, found in bench.find(batch.column(1)).items():
                    rows += [(ids[row], bench.items[k].id, c, len(bench.items[k].words), a, b) for k, (c, a, b) in found.items()]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
                names = ["doc_id", "item_id", "edits", "item_words", "start", "end"]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=names)

        found = documents.select("doc_id", "text").mapInArrow(tidy(run), schema)
        out = found if out is None else out.unionByName(found)
    return out


def without_leaks(documents: DataFrame, benchmark: DataFrame, max_edits: float = 0.2, recall: float = 0.99, block: int = 20_000) -> DataFrame:
    """`documents` without the contaminated rows; same columns."""
    small_batches(documents.sparkSession)
    at, schema = documents.columns.index("text"), documents.schema
    for items in item_blocks(benchmark, block):
        shared = documents.sparkSession.sparkContext.broadcast(Benchmark(items, max_edits, recall))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bad = shared.value.find(batch.column(at))
                yield batch.filter(pa.array([i not in bad for i in range(batch.num_rows)], pa.bool_()))

        documents = documents.mapInArrow(tidy(run), schema)
    return documents


