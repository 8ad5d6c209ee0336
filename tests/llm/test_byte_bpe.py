import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from caretrail.llm import byte_bpe
from caretrail.llm.byte_bpe import RANKS, ByteBpe, byte_bpe_digest, cuts, with_text, with_tokens

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("plain", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def bpe():
    return ByteBpe.load()


def odd_texts():
    rng = random.Random(7)
    letters = "aaabcdeE 's've\n\t  \x00\x1c\x85  é日本😀👩‍👧न01٣²_-+#́İſ"
    out = ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(1500)]
    out += ["", " ", "  ", "\n\n a", "a" * 3000, "ab" * 2000, " " * 999 + "x", "x" + " " * 999, "<|endoftext|>", "𝔘𝔫𝔦" * 50]
    return out + ["".join(map(chr, rng.choices([*range(1, 0xD800), *range(0xE000, 0x20000)], k=40))) for _ in range(500)]


def test_ids_equal_the_plain_library(plain, bpe):
    texts = odd_texts()
    for text, ids in zip(texts, bpe.encode_many(texts), strict=True):
        assert ids.tolist() == plain.encode_ordinary(text), text
        assert bpe.raw(ids) == text.encode() and "".join(bpe.texts_of(ids)) == text


def test_cuts_change_nothing(plain, bpe, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CUT", 5)
    texts = odd_texts()
    assert any(len(list(cuts(t))) > 3 for t in texts)
    for text, ids in zip(texts, bpe.encode_many(texts), strict=True):
        assert "".join(cuts(text)) == text and ids.tolist() == plain.encode_ordinary(text), text


def test_spans_cover_the_characters_of_each_token(plain, bpe):
    split = 0
    for text in odd_texts():
        ids = bpe.encode_many([text])[0]
        starts, ends = bpe.spans(text, ids)
        size = [len(plain.decode_single_token_bytes(i)) for i in ids.tolist()]
        owner = [i for i, c in enumerate(text) for _ in c.encode()]  # character of each byte
        at = 0
        for n, a, b in zip(size, starts.tolist(), ends.tolist(), strict=True):
            assert (a, b) == (owner[at], owner[at + n - 1] + 1)
            at += n
        split += int((ends[:-1] > starts[1:]).sum())
    assert split > 100


def test_split_characters_come_with_the_token_that_completes_them(bpe):
    ids = bpe.encode_many(["a👧b"])[0]
    parts = bpe.texts_of(ids)
    assert "".join(parts) == "a👧b" and "" in parts
    assert bpe.texts_of(ids[:2]) == ["a", "�"]  # the character never comes
    assert bpe.raw(np.array([-1, 10**6])) == "��".encode()


def test_query_equals_brute_force(spark, plain):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang")
    extra = [(9001, None, "x"), (9002, "", "x"), (None, "no id 👩‍👧", None), (9003, "same", "x"), (9003, "same", "x"), (9004, "word 12 " * 60_000, "x")]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema)).withColumnRenamed("lang", "ids")
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    expected = []
    for r in docs.collect():
        ids = plain.encode_ordinary(r.text or "")
        expected.append((str(r.doc_id), len(ids), sha(" ".join(map(str, ids)).encode()), sha((r.text or "").encode()), len(r.text or "")))
    found = byte_bpe_digest(docs)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_chars"]
    assert sorted((str(r[0]), *r[1:]) for r in found.collect()) == sorted(expected)
    assert byte_bpe_digest(docs.limit(0)).collect() == []


def test_kept_columns_and_bytes_that_are_no_text(spark, bpe):
    rows = spark.sql("select 1 ids, 'k' starts, 'v' raw, cast(X'61FF62' as string) text union all select 2, null, null, null")
    out = with_tokens(rows, bpe, keep=("ids", "starts", "text", "raw"))
    assert out.columns == ["ids_in", "starts_in", "text", "raw", "ids", "starts", "ends"]
    back = with_text(out, bpe, keep=("ids_in", "raw", "ids"), pieces=True)
    assert back.columns == ["ids_in", "raw_in", "ids", "raw", "pieces"]
    found = {r.ids_in: r for r in back.collect()}
    assert bytes(found[1].raw).decode() == "a�b" and found[1].raw_in == "v" and "".join(found[1].pieces) == "a�b"
    assert bytes(found[2].raw) == b"" and found[2].ids == [] and found[2].pieces == []
    lone = with_text(spark.sql("select array(64, null, 65) as t union all select null"), bpe, ids="t").collect()
    assert sorted(bytes(r.raw).decode() for r in lone) == ["", "a�b"]
