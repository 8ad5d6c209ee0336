import random
import zlib
from collections import defaultdict

from caretrail.llm.sharding import quantiles, shard


def check(rows, out, shards=40):
    assert sorted((r.doc_id is None, r.doc_id, r.size, r.text_crc32) for r in out) == sorted(
        (i is None, i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows
    )
    by = defaultdict(list)
    for r in out:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        by[r.shard].append(r)
    total, largest = sum(r.size for r in out), max(r.size for r in out)
    for rows_of in by.values():
        assert sorted(r.slot for r in rows_of) == list(range(len(rows_of)))
        assert abs(sum(r.size for r in rows_of) - total / shards) <= 2 * largest
    keys = [(r.text_crc32, -1 if r.doc_id is None else r.doc_id) for r in sorted(out, key=lambda r: (r.shard, r.slot))]
    assert keys == sorted(keys)


def test_hot_text_and_odd_rows(spark):
    dice = random.Random(3)
    rows = [(i, "same text of many rows", "x") for i in range(700)]
    rows += [(1000 + i, "w" * dice.randrange(300), "y") for i in range(900)]
    rows += [(None, None, None), (5, "", "z"), (5, "", "z"), (None, "é" * 50, "a")] + [(7, "again", "r")] * 300
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(5)
    check(rows, shard(df, range_bytes=2000).collect())


def test_few_rows(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    (row,) = shard(df).collect()
    assert (row.doc_id, row.size, row.slot) == (1, 17, 0) and 0 <= row.shard < 40
    assert shard(df.limit(0)).count() == 0


def test_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    check([(r.doc_id, r.text) for r in df.collect()], shard(df).collect())


def test_quantiles_cut_weight():
    assert quantiles([((i, 0, 0), 1) for i in range(100)], 4) == [(25, 0, 0), (50, 0, 0), (75, 0, 0)]
    assert quantiles([], 4) == []
