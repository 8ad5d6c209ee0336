import base64
import gzip
import hashlib
import random

import __spark_entry__ as entry
from caretrail.checks.compare import compare, connect
from caretrail.llm.stored import Scratch
from caretrail.llm.warc import COLUMNS, LoserTree, archive_and_index, archive_digest, key, merge_index, parse, read_archives, record, url_key, write_archives


def expected(rows):
    def digest(html):
        return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()

    first = {}
    for i, _, html, *_ in rows:
        first[digest(html)] = max([x for x in (first.get(digest(html)), i) if x is not None], default=None)
    out = []
    for i, _, html, *_ in rows:
        f = first[digest(html)]
        out.append((i, len((html or "").encode()), digest(html), "response" if i == f else "revisit", None if i == f else f))
    return sorted(out, key=repr)


ODD = [
    (1, "http://A.b.com/x?q=1#f", "<p>é\r\n\r\nWARC/1.1\r\n\r\n</p>", "clash"),
    (2, None, None, "clash"),
    (3, "", "", None),
    (None, "http://c.d/\r\nX: y", "same", "a"),
    (9, "http://c.d/", "same", "a"),
    (9, "http://c.d/", "same", "a"),
    (None, "http://e.f", "alone without id", "a"),
    (12, "http://z", "x" * 400_000, "long"),
]


def test_odd_pages_round_trip(spark):
    df = spark.createDataFrame(ODD, "page_id long, url string, html string, archive string").repartition(3)
    out = sorted((tuple(r) for r in archive_digest(df).collect()), key=repr)
    assert out == expected(ODD)
    assert archive_digest(df.limit(0)).count() == 0


def test_index_is_in_global_order(spark):
    dice = random.Random(1)
    rows = [(i, f"http://h{dice.randrange(3)}.x.com/{dice.randrange(9)}", str(dice.randrange(40))) for i in range(3000)]
    rows += [(i, "http://hot.com/", "hot") for i in range(3000, 4500)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    scratch = Scratch(spark, "test-warc")
    write_archives(df, scratch, records_per_file=150)
    runs = scratch.store(read_archives(spark, scratch.path("archives")), "runs")
    out = merge_index(runs, range_rows=300).collect()
    assert len({r.archive for r in out}) > 20
    keys = [key(tuple(r[c] for c in COLUMNS)) for r in sorted(out, key=lambda r: (r.segment, r.position))]
    assert keys == sorted(keys) and len(set(keys)) == len(rows)
    assert max(sum(r.segment == s for r in out) for s in {r.segment for r in out}) < 700
    assert archive_and_index(df).count() == len(rows)


def test_loser_tree():
    dice = random.Random(2)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = []
        for run in range(k):
            rows = [(dice.randrange(5), None, "t", dice.choice("ab"), "", "", 0, None, f"r{run}") for _ in range(dice.randrange(6))]
            rows.sort(key=lambda r: (r[3], r[2], r[0]))
            runs.append([(*r, i) for i, r in enumerate(rows)])
        assert list(LoserTree(runs)) == sorted((r for run in runs for r in run), key=key)


def test_archives_of_one_member_a_record():
    sha1 = hashlib.sha1(b"hello").hexdigest()
    packed = b"".join(gzip.compress((record(i, "http://x/", "hello", sha1, 2) + "\r\n").encode()) for i in (2, 1))
    assert [(r[0], r[4], r[6], r[7]) for r in parse(packed, "a")] == [(1, "revisit", 5, 2), (2, "response", 5, None)]


def test_url_keys():
    assert url_key("HTTP://www.A.com/B?c#d") == "com,a,www)/b?c"
    assert url_key(None) == url_key("") == ""


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    result = compare(entry.queries()["op10_warc"], entry.oracle_sql()["op10_warc"], spark, connect(folder), folder)
    assert result["ok"], result["why"]
