"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

The pieces and their log scores are read from a model file, whose path is a parameter; nothing is trained. A text gets the
whitespace marker in front (if it is not empty) and for each space; the best segmentation is the one with the greatest sum
of scores, the longer last piece at a tie. A character without a piece costs the least score less ten and is spelled in
byte pieces. Decoding joins the pieces, byte pieces as bytes, turns markers into spaces and takes the first one off.

In the trie the marker is the byte of a space, so a marker character of the text itself is no whitespace: it is spelled in
bytes and every text comes back as it was. No piece holds a marker after another character (checked on loading; else texts
are not cut), so a text is cut before its whitespace, distinct cuts are segmented together, one array operation a byte of
depth for all of them, and a worker keeps up to `keep` cuts of earlier texts.

Defined cases: a null text is an empty one; an empty text has no pieces and decodes to an empty text; texts of any length are
segmented whole, cut or not. Ids that no piece has are skipped by the decoder, bytes that are no UTF-8 become U+FFFD. Repeated rows each get their pieces; an empty table
gives an empty one. A kept column that has the name of a result, or of another kept one, gets `_in` behind its name; no column name is reserved.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from caretrail.llm.names import laid_out
from caretrail.llm.stored import small_batches, tidy

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
CUTS = re.compile(r" *[^ ]+| +")
LONG = 96  # bytes; longer cuts are segmented one by one


class DoubleArray:
    """Trie over bytes: the child of state s by byte b is t = base[s] + b + 1, if check[t] is s; value[t] is a piece or -1."""

    def __init__(self, keys: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        piece_of = [-1]
        for word, piece in keys.items():
            node = 0
            for byte in word:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    piece_of.append(-1)
                node = children[node][byte]
            piece_of[node] = piece
        size = 2 * len(children) + 1024
        base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        taken, first = bytearray(size), 1
        taken[0] = 1
        place, work = {0: 0}, [0]
        for node in work:
            own = sorted(children[node])
            if not own:
                continue
            while taken[first]:
                first += 1
            at, tries = max(0, first - own[0] - 1), 0
            while any(taken[at + byte + 1] for byte in own):
                at, tries = at + 1, tries + 1
                if at + 257 >= size:
                    more = size
                    base, check, value = np.pad(base, (0, more)), np.pad(check, (0, more), constant_values=-1), np.pad(value, (0, more), constant_values=-1)
                    taken, size = taken + bytearray(more), size + more
            if tries > 64:  # a crowded stretch: its holes are left
                first = at + own[0] + 1
            state = place[node]
            base[state] = at
            for byte in own:
                child, to = children[node][byte], at + byte + 1
                taken[to], check[to], value[to], place[child] = 1, state, piece_of[child], to
                work.append(child)
        last = max(place.values()) + 258
        self.base, self.check, self.value = (np.pad(a[:last], (0, max(0, last - size)), constant_values=c) for a, c in ((base, 0), (check, -1), (value, -1)))
        self.depth = max(map(len, keys), default=0)


def char_bytes(lead: np.ndarray) -> np.ndarray:
    """Bytes of the character that starts with the given byte."""
    return np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))


class Pieces:
    """A vocabulary with its encoder and decoder; small enough to go to every worker (32,000 pieces: 2 MB)."""

    def __init__(self, pieces: list[tuple[str, float, str]]):
        """`pieces`: text, score and kind (normal, byte or other) by id."""
        self.text, self.byte_ids, keys, scores = [], np.full(256, -1, np.int32), {}, np.zeros(len(pieces))
        for i, (text, score, kind) in enumerate(pieces):
            scores[i] = score
            if kind == "byte":
                self.byte_ids[int(text[3:5], 16)] = i
                self.text.append(bytes([int(text[3:5], 16)]))
            elif kind == "normal":
                keys[text.replace(MARK, " ").encode()] = i
                self.text.append(text.replace(MARK, " ").encode())
            else:
                self.text.append(b"")
        self.scores, self.trie = scores, DoubleArray(keys)
        self.unknown = min((scores[i] for i in keys.values()), default=0.0) - UNKNOWN_PENALTY
        self.unknown_id = next((i for i, p in enumerate(pieces) if p[2] == "unknown"), 0)
        self.fallback = bool((self.byte_ids >= 0).all())
        self.cuttable = not any(b" " in key.lstrip(b" ") for key in keys)

    @classmethod
    def load(cls, path: str = MODEL) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)

        def kind(i: int) -> str:
            if model.is_byte(i):
                return "byte"
            return "unknown" if model.is_unknown(i) else "other" if model.is_control(i) or model.is_unused(i) else "normal"

        return cls([(model.id_to_piece(i), model.get_score(i), kind(i)) for i in range(model.get_piece_size())])

    def spelled(self, raw: bytes) -> list[int]:
        return [int(self.byte_ids[b]) for b in raw] if self.fallback else [self.unknown_id]

    def segment_one(self, raw: bytes) -> list[int]:
        """Viterbi of one long cut."""
        base, check, value, scores = self.trie.base, self.trie.check, self.trie.value, self.scores
        n = len(raw)
        best, start, piece = [float("-inf")] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            here = best[i]
            if here == float("-inf"):
                continue
            lead = raw[i]
            width = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            state, single = 0, False
            for j in range(i, n):
                to = base[state] + raw[j] + 1
                if check[to] != state:
                    break
                state, found = to, value[to]
                if found >= 0:
                    single |= j + 1 - i == width
                    if here + scores[found] > best[j + 1]:
                        best[j + 1], start[j + 1], piece[j + 1] = here + scores[found], i, found
            if not single and here + self.unknown > best[i + width]:
                best[i + width], start[i + width], piece[i + width] = here + self.unknown, i, -1
        out, at = [], n
        while at:
            out.append([int(piece[at])] if piece[at] >= 0 else self.spelled(raw[start[at] : at]))
            at = start[at]
        return [i for part in reversed(out) for i in part]

    def segment(self, cuts: list[bytes]) -> list[bytes]:
        """Piece ids of each cut, as packed int32; cuts of like length side by side."""
        out: list[bytes] = [b""] * len(cuts)
        order = sorted(range(len(cuts)), key=lambda i: len(cuts[i]))
        while order and len(cuts[order[-1]]) > LONG:
            i = order.pop()
            out[i] = np.array(self.segment_one(cuts[i]), np.int32).tobytes()
        for at in range(0, len(order), 8192):
            rows = order[at : at + 8192]
            for i, ids in zip(rows, self._together([cuts[i] for i in rows]), strict=True):
                out[i] = ids
        return out

    def _together(self, cuts: list[bytes]) -> list[bytes]:
        """The same as `segment_one` for many cuts, with an array operation for each start and depth."""
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        size = np.array([len(c) for c in cuts])
        longest, n = int(size.max(initial=0)), len(cuts)
        text = np.zeros((n, longest + 4), np.int32)
        flat = np.frombuffer(b"".join(cuts), np.uint8)
        text[np.arange(longest + 4) < size[:, None]] = flat
        best = np.full((n, longest + 5), -np.inf)
        start = np.zeros((n, longest + 5), np.int16)
        piece = np.full((n, longest + 5), -1, np.int32)
        best[:, 0] = 0.0
        for i in range(longest):
            rows = np.flatnonzero((size > i) & (best[:, i] > -np.inf))
            if not len(rows):
                continue
            here, width = best[rows, i], char_bytes(text[rows, i])
            unseen = np.ones(len(rows), bool)
            live, state = np.arange(len(rows)), np.zeros(len(rows), np.int32)
            for depth in range(1, min(self.trie.depth, longest - i) + 1):
                row = rows[live]
                inside = size[row] >= i + depth
                live, state, row = live[inside], state[inside], row[inside]
                to = base[state] + text[row, i + depth - 1] + 1
                ok = check[to] == state
                live, state, row = live[ok], to[ok], row[ok]
                if not len(live):
                    break
                found = value[state]
                hit = found >= 0
                if hit.any():
                    who, found, row = live[hit], found[hit], row[hit]
                    unseen[who[width[who] == depth]] = False
                    score = here[who] + self.scores[found]
                    better = score > best[row, i + depth]
                    row = row[better]
                    best[row, i + depth], start[row, i + depth], piece[row, i + depth] = score[better], i, found[better]
            row, to = rows[unseen], i + width[unseen]
            score = here[unseen] + self.unknown
            better = score > best[row, to]
            row, to = row[better], to[better]
            best[row, to], start[row, to], piece[row, to] = score[better], i, -1
        # Back from the ends, all cuts at once: ids fill the rows from the right.
        ids, at, column, every = np.zeros((n, longest), np.int32), size.copy(), longest, np.arange(n)
        odd = np.zeros(n, bool)
        count = np.zeros(n, np.int64)
        while (live := at > 0).any():
            column -= 1
            who = every[live]
            got = piece[who, at[who]]
            odd[who[got < 0]] = True
            count[who] += 1
            ids[who, longest - count[who]] = got
            at[who] = start[who, at[who]]
        packed = [ids[i, longest - count[i] :].tobytes() for i in range(n)]
        for i in np.flatnonzero(odd):  # spell characters without a piece
            spelled, end = [], int(size[i])
            while end:
                begin = int(start[i, end])
                spelled.append([int(piece[i, end])] if piece[i, end] >= 0 else self.spelled(cuts[i][begin:end]))
                end = begin
            packed[i] = np.array([p for part in reversed(spelled) for p in part], np.int32).tobytes()
        return packed

    def cuts(self, text: str) -> list[str]:
        if not text:
            return []
        return CUTS.findall(" " + text) if self.cuttable else [" " + text]

    def encode_many(self, texts: Iterable[str | None], known: dict[str, bytes] | None = None) -> list[bytes]:
        """Piece ids of each text as packed int32; `known` is filled with the cuts met."""
        known = {} if known is None else known
        cut = [self.cuts(t or "") for t in texts]
        fresh = list({c for own in cut for c in own if c not in known})
        known.update(zip(fresh, self.segment([c.encode() for c in fresh]), strict=True))
        return [b"".join([known[c] for c in own]) for own in cut]

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_many([text])[0], np.int32).tolist()

    def decode(self, ids: Iterable[int]) -> str:
        known = self.text
        raw = b"".join([known[i] for i in ids if 0 <= i < len(known)])
        return raw.removeprefix(b" ").decode(errors="replace")


def _slices(texts: list[str | None], most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= most:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def with_pieces(df: DataFrame, pieces: Pieces, text: str = "text", keep: tuple[str, ...] = (), known_cuts: int = 100_000) -> DataFrame:
    """The kept columns, `ids` (array of int) and `decoded` (the text back from the ids), row by row, without a shuffle."""
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(pieces)  # as large as the vocabulary
    source, schema = laid_out(df, keep, F.col(text), StructType().add("ids", ArrayType(IntegerType())).add("decoded", "string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = shared.value, {}
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            for begin, end in _slices(texts):
                if len(known) > known_cuts:
                    known.clear()
                ids = [np.frombuffer(p, np.int32) for p in own.encode_many(texts[begin:end], known)]
                columns = [batch.column(i).slice(begin, end - begin) for i in range(len(keep))]
                offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids) if ids else [], pa.int32())))
                columns.append(pa.array([own.decode(i.tolist()) for i in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(tidy(run), schema)


def ids_sha256(ids: Iterable[int]) -> str:
    """Hash of the ids as decimal numbers joined by commas, as the digest has it."""
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def piece_digest(documents: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, how many pieces and byte pieces the whole text has, a hash of the ids, and whether they decode to the text."""
    pieces = Pieces.load(model)
    source = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    out = with_pieces(source, pieces, keep=("doc_id", "text"))
    byte_ids = [int(i) for i in pieces.byte_ids if i >= 0]
    low, high = min(byte_ids, default=0), max(byte_ids, default=-1)
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        F.size(F.filter("ids", lambda i: i.between(low, high))).cast("long").alias("n_byte_pieces"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.col("text")).alias("round_trip"),
    )
