"""Byte-level BPE: token ids and character spans of whole texts, and texts back from ids.

The merges are derived from a rank file and run by the tokenizers library in Arrow batches. A rank file says which byte strings
are tokens and which is merged first; a merge list says it by pairs, so every split of a token into two tokens becomes a pair, in
the order of the ranks. Matches of the split pattern are encoded one by one, and a match that is a token is taken as it is; a match
met again in a task is looked up.

Defined results: null and empty texts have no tokens and decode to an empty text. Bytes that are not UTF-8 are read as U+FFFD.
Ids that no token has, null ones among them, decode to U+FFFD. Rows are treated alone, so ties and repeated rows give equal results, and an
empty table gives an empty one. A kept column with the name of a result comes back with `_in` added. A text is encoded in cuts
of about `CUT` characters, made where no match of the pattern can reach across, so a long text costs no more memory than a cut;
only a run of symbols without such a place is encoded in one.
"""

from __future__ import annotations

import base64
import codecs
import os
import re
from array import array
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType
from tokenizers import Tokenizer, models, pre_tokenizers

from caretrail.llm.names import laid_out
from caretrail.llm.stored import small_batches, tidy

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
CUT = 1 << 16
KNOWN = 400_000  # matches a task remembers before it begins anew
BATCH = 1 << 20  # characters of texts encoded together
# A match never holds a blank after another character, nor an ASCII letter beside a digit.
BORDER = re.compile(r"(?<=[!-~])(?=[ \n])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")
REPLACEMENT = "�".encode()


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it prints, else the next free one from 256 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(free)) for b in range(256)]


def pairs_of(ranks: dict[bytes, int]) -> Iterator[tuple[bytes, bytes]]:
    """Every way to make a token of two tokens, in the order in which merges apply."""
    for token in sorted(ranks, key=ranks.__getitem__):
        splits = [(token[:k], token[k:]) for k in range(1, len(token)) if token[:k] in ranks and token[k:] in ranks]
        yield from sorted(splits, key=lambda s: (ranks[s[0]], ranks[s[1]]))


@lru_cache(maxsize=4)
def _tokenizer(spec: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
    return Tokenizer.from_str(spec)


class ByteBpe:
    """A vocabulary: the tokenizer as text, and the bytes of every id in one table."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN):
        letters = byte_characters()
        spelled = {token: "".join([letters[b] for b in token]) for token in ranks}
        merges = [(spelled[a], spelled[b]) for a, b in pairs_of(ranks)]
        own = Tokenizer(models.BPE(vocab={spelled[t]: i for t, i in ranks.items()}, merges=merges, ignore_merges=True))
        own.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.spec, self.pattern = own.to_str(), pattern
        # The way back: characters of the vocabulary to bytes, laid out one id after the other, an unknown id last.
        byte_of = {c: b for b, c in enumerate(letters)}
        raw = [REPLACEMENT] * (max(ranks.values(), default=-1) + 2)
        for word, i in own.get_vocab().items():
            raw[i] = bytes([byte_of[c] for c in word])
        self.size = np.array([len(r) for r in raw], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)[:-1]])
        self.pool = np.frombuffer(b"".join(raw), np.uint8)

    @classmethod
    def load(cls, path: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> ByteBpe:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}, pattern)

    def encode_many(self, texts: Sequence[str], known: dict[str, bytes] | None = None) -> list[np.ndarray]:
        """Ids of each text; `known` is filled with the packed ids of the matches met."""
        known, find = {} if known is None else known, regex.compile(self.pattern).findall
        out = []
        for text in texts:
            packed = []
            for cut in cuts(text):
                matches = find(cut)
                fresh = [m for m in set(matches) if m not in known]
                if len(known) + len(fresh) > KNOWN:
                    known.clear()
                    fresh = list(set(matches))
                for match, coded in zip(fresh, _tokenizer(self.spec).encode_batch_fast(fresh, add_special_tokens=False), strict=True):
                    known[match] = array("i", coded.ids).tobytes()
                packed += [known[m] for m in matches]
            out.append(np.frombuffer(b"".join(packed), np.int32))
        return out

    def known(self, ids: np.ndarray) -> np.ndarray:
        last = len(self.size) - 1
        return np.where((ids >= 0) & (ids < last), ids, last)

    def raw(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids, one after the other."""
        ids = self.known(np.asarray(ids, np.int64))
        size = self.size[ids]
        ends = np.cumsum(size)
        if not len(ids):
            return b""
        return self.pool[np.repeat(self.start[ids] - (ends - size), size) + np.arange(ends[-1])].tobytes()

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First character and end of each token in code points; tokens that share a split character both cover it."""
        data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        character = np.cumsum((data & 0xC0) != 0x80) - 1  # of each byte
        ends = np.cumsum(self.size[ids])
        if not len(ids):
            return np.zeros(0, np.int32), np.zeros(0, np.int32)
        return character[ends - self.size[ids]].astype(np.int32), (character[ends - 1] + 1).astype(np.int32)

    def texts_of(self, ids: np.ndarray) -> list[str]:
        """The text that each token completes: a character split over tokens comes with the last of them.

        Joined they are the decoded text. Bytes that never become a character are U+FFFD, with the token where that shows.
        """
        ids = self.known(np.asarray(ids, np.int64))
        reader, out = codecs.getincrementaldecoder("utf-8")("replace"), []
        for i, at in enumerate(ids.tolist()):
            out.append(reader.decode(self.pool[self.start[at] : self.start[at] + self.size[at]].tobytes(), i + 1 == len(ids)))
        return out


def cuts(text: str) -> Iterator[str]:
    """The text in parts of about `CUT` characters, cut only where matches of the pattern end anyway."""
    begin = 0
    while len(text) - begin > CUT:
        border = BORDER.search(text, begin + CUT)
        if not border:
            break
        yield text[begin : border.start()]
        begin = border.start()
    if begin < len(text):
        yield text[begin:]


def _slices(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    begin = total = i = 0
    for i, size in enumerate(sizes, 1):
        total += size
        if total >= most:
            yield begin, i
            begin, total = i, 0
    if begin < i:
        yield begin, i


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values) if values else [], pa.int32()))


def with_tokens(df: DataFrame, bpe: ByteBpe, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The kept columns, `ids`, and `starts` and `ends` of the tokens in code points, row by row, without a shuffle."""
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(bpe)  # as large as the vocabulary
    numbers = ArrayType(IntegerType())
    source, schema = laid_out(df, keep, F.col(text).cast("binary"), StructType().add("ids", numbers).add("starts", numbers).add("ends", numbers))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = shared.value, {}
        for batch in batches:
            raw = batch.column(len(keep))
            for begin, end in _slices([len(r.as_buffer()) if r.is_valid else 0 for r in raw], BATCH):
                texts = [(r or b"").decode("utf-8", "replace") for r in raw.slice(begin, end - begin).to_pylist()]
                ids = own.encode_many(texts, known)
                spans = [own.spans(t, i) for t, i in zip(texts, ids, strict=True)]
                columns = [batch.column(i).slice(begin, end - begin) for i in range(len(keep))]
                columns += [_lists(ids), _lists([s for s, _ in spans]), _lists([e for _, e in spans])]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(tidy(run), schema)


def with_text(df: DataFrame, bpe: ByteBpe, ids: str = "ids", keep: tuple[str, ...] = (), pieces: bool = False) -> DataFrame:
    """The kept columns, the decoded bytes `raw` and, if asked for, `pieces`: the text that each token completes."""
    shared = df.sparkSession.sparkContext.broadcast(bpe)
    results = StructType().add("raw", "binary")
    if pieces:
        results.add("pieces", ArrayType(StringType()))
    source, schema = laid_out(df, keep, F.coalesce(F.col(ids).cast("array<int>"), F.array().cast("array<int>")), results)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            lists = batch.column(len(keep))
            for begin, end in _slices([len(v) for v in lists], BATCH):
                some = lists.slice(begin, end - begin)
                flat, at = some.flatten().fill_null(-1).to_numpy(zero_copy_only=False), some.offsets.to_numpy() - some.offsets[0].as_py()
                parts = [flat[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
                columns = [batch.column(i).slice(begin, end - begin) for i in range(len(keep))]
                columns.append(pa.array([own.raw(p) for p in parts], pa.binary()))
                if pieces:
                    columns.append(pa.array([own.texts_of(p) for p in parts], pa.list_(pa.string())))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(tidy(run), schema)


def byte_bpe_digest(documents: DataFrame, path: str = RANKS) -> DataFrame:
    """doc_id, number and hash of the tokens, hash of the decoded bytes, and the end of the last span: the text's code points."""
    bpe = ByteBpe.load(path)
    coded = with_tokens(documents, bpe, keep=("doc_id",)).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).cast("long").alias("n_chars"),
        "ids",
    )
    kept = ("doc_id", "n_tokens", "ids_sha256", "n_chars")
    return with_text(coded, bpe, keep=kept).select("doc_id", "n_tokens", "ids_sha256", F.sha2("raw", 256).alias("decoded_sha256"), "n_chars")
