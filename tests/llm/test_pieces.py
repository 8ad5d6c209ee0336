import hashlib

import pytest

from caretrail.llm.pieces import MARK, MODEL, Pieces, ids_sha256, piece_digest, with_pieces

ODD = [None, "", " ", "   ", "hello  world\n\tnewü", f"a{MARK}b {MARK}", "日本語 テキスト😀", "x" * 3000, " lead and trail  ", "\x00\x01", "<0x41> <s>"]


@pytest.fixture(scope="module")
def pieces():
    return Pieces.load()


@pytest.fixture(scope="module")
def library(tmp_path_factory):
    """The public library with the same pieces as a unigram model."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    model.ParseFromString(open(MODEL, "rb").read())
    model.trainer_spec.model_type = 1
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(model.SerializeToString())
    return sentencepiece.SentencePieceProcessor(model_file=str(path))


def brute(p: Pieces, text: str) -> float:
    """Score of the best segmentation, by trying every piece at every place; whole text, no cuts, no trie."""
    keys = {t: p.scores[i] for i, t in enumerate(p.text) if t and i not in set(map(int, p.byte_ids)) | {0, 1, 2}}
    raw = (" " + text).encode()
    best = [0.0] + [float("-inf")] * len(raw)
    for i in range(len(raw)):
        if best[i] == float("-inf"):
            continue
        width = next(w for w in (1, 2, 3, 4) if _whole(raw[i : i + w]))
        for j in range(i + 1, min(len(raw), i + p.trie.depth) + 1):
            if raw[i:j] in keys:
                best[j] = max(best[j], best[i] + keys[raw[i:j]])
        if raw[i : i + width] not in keys:
            best[i + width] = max(best[i + width], best[i] + p.unknown)
    return best[-1]


def _whole(raw):
    try:
        return len(raw.decode()) == 1
    except UnicodeDecodeError:
        return False


def score(p, ids):
    byte_ids, total, run = set(map(int, p.byte_ids)), 0.0, []
    for i in ids:
        if i in byte_ids:
            run.append(p.text[i])
            if _whole(b"".join(run)):
                total, run = total + p.unknown, []
        else:
            total += p.scores[i]
    return total


def test_round_trip_and_best_score(pieces):
    for text in ODD[1:]:
        ids = pieces.encode(text)
        assert pieces.decode(ids) == text
        assert not text or len(text) > 1000 or score(pieces, ids) == pytest.approx(brute(pieces, text), abs=1e-3)


def test_together_equals_one_by_one(pieces):
    cuts = [f" {w}".encode() for w in ("the", "thé", "日本", "aaaaaaaaaaaaaaaaaaaaaaa", "\n", "", "a\nb", "internationalisation", "ß" * 30)]
    import numpy as np

    assert [np.frombuffer(b, np.int32).tolist() for b in pieces.segment(cuts)] == [pieces.segment_one(c) for c in cuts]


def test_equals_the_library(pieces, library, spark):
    """For words whose characters all have a piece, and never a worse sum where the library segments otherwise."""
    words = {w for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect() for w in (r.text or "").split()[:60]}
    plain = [w for w in words if not set(pieces.encode(w)) & set(map(int, pieces.byte_ids))]
    assert len(plain) > 1000
    other = [w for w in plain if pieces.encode(w) != library.encode(w)]
    assert len(other) / len(plain) < 0.01
    assert all(score(pieces, pieces.encode(w)) >= score(pieces, library.encode(w)) for w in other)


def test_digest_of_odd_rows(spark, pieces):
    rows = [(i if i != 4 else None, t, "k", 1) for i, t in enumerate([*ODD, ODD[4], ODD[4]])]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded int")
    out = {(r.doc_id, r.decoded_sha256): r for r in piece_digest(df).collect()}
    assert piece_digest(df).count() == len(rows)
    for i, text, *_ in rows:
        r = out[i, hashlib.sha256((text or "").encode()).hexdigest()]
        ids = pieces.encode(text)
        assert r.round_trip and r.n_pieces == len(ids) and r.ids_sha256 == ids_sha256(ids)
        assert r.n_byte_pieces == sum(i in set(map(int, pieces.byte_ids)) for i in ids)
    assert piece_digest(df.limit(0)).count() == 0


def test_documents_round_trip(spark, pieces):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert piece_digest(df).where("not round_trip").count() == 0
    assert with_pieces(df, pieces, keep=("doc_id",)).count() == df.count()


def test_decoder_takes_any_ids(pieces):
    assert pieces.decode([10**6, -1, 1, 2]) == "" and pieces.decode([int(pieces.byte_ids[255])]) == "�"


def test_kept_columns_with_names_of_results(spark):
    df = spark.createDataFrame([(1, "mine", "x", "a text")], "doc_id long, ids string, __text string, text string")
    out = with_pieces(df, Pieces.load(), keep=("doc_id", "ids", "__text"))
    assert out.columns == ["doc_id", "ids_in", "__text", "ids", "decoded"]
    assert (out.first().ids_in, out.first().decoded) == ("mine", "a text")
