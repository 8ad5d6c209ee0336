import random
import re
from itertools import permutations

from caretrail.checks.compare import compare, connect
from caretrail.llm.filter_audit import ORACLE, failure_combinations, filter_audit

FOLDER = "/root/testdata/sf0.001"
DOCS, LABELS = "doc_id long, text string, lang string, source string, part string, bits int", "doc_id long, quality int, toxic int"


def brute(rows, labels):
    """Every order applied left to right to every document."""
    docs = []
    for doc, text, _, source, *_ in rows:
        text, fails = text or "", set()
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        if len(words) < 50:
            fails.add("A")
        if 100 * len(set(words)) < 65 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text):
            fails.add("C")
        if re.search(r"[#$%&*|]", text):
            fails.add("D")
        if doc is not None and any(o[0] is not None and o[0] < doc and (o[1] or "") == text for o in rows):
            fails.add("E")
        own = [x for x in labels if doc is not None and x[0] == doc]
        docs.append((source or "", fails, any(x[1] == 1 for x in own), any(x[2] == 1 for x in own)))
    out, shapley = {}, {}
    for part in {d[0] for d in docs}:
        for order in map("".join, permutations("ABCDE")):
            left = [d for d in docs if d[0] == part]
            for step, f in enumerate(order, 1):
                hit = [d for d in left if f in d[1]]
                failing = sum(f in d[1] for d in docs if d[0] == part)
                unique = sum(d[1] == {f} for d in docs if d[0] == part)
                left = [d for d in left if f not in d[1]]
                out[part, order, step] = [len(left), len(hit), failing - len(hit), unique, sum(d[2] for d in hit), sum(d[3] for d in hit)]
                shapley[part, f] = shapley.get((part, f), 0) + len(hit)
    return {(*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def found(spark, rows, labels):
    df = filter_audit(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS))
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_equals_brute_force_on_odd_rows(spark):
    rng = random.Random(3)
    many = " ".join(f"w{i}" for i in range(60))
    texts = [None, "", " \t\x0b\x0c\r\n", many, many + " #", many.replace("w", "W"), "word " * 70, "A b c", "%", many + "\x85x y", "ß" * 19 + "A", "ß" * 20 + "A", "x " * 50]
    rows = [(rng.choice([None, *range(30)]), rng.choice(texts), "en", rng.choice([None, "", "p", "q"]), "p", 3) for _ in range(200)]
    labels = [(rng.choice([None, *range(30)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for _ in range(60)]
    assert found(spark, rows, labels) == brute(rows, labels)


def test_empty_tables(spark):
    assert found(spark, [], []) == set()
    rows = [(1, "a", "en", "s", "p", 1), (2, "a", "en", "s", "p", 1)]
    assert found(spark, rows, []) == brute(rows, [])


def test_same_rows_and_ids_are_no_copies_of_themselves(spark):
    rows = [(5, "a", "en", "s", "p", 1)] * 3 + [(5, "b", "en", "s", "p", 1), (7, "b", "en", "t", "p", 1)]
    assert found(spark, rows, [(5, 1, 0), (5, 0, 1)]) == brute(rows, [(5, 1, 0), (5, 0, 1)])


def test_one_large_group_of_copies(spark):
    rows = [(i, "the same text", "en", "s" if i % 3 else "t", "p", 0) for i in range(3000)]
    df = failure_combinations(spark.createDataFrame(rows, DOCS), spark.createDataFrame([], LABELS))
    assert sorted((r.part, r.bits, r.n) for r in df.collect()) == [("s", 17, 2000), ("t", 1, 1), ("t", 17, 999)]


def test_query_equals_sql(spark):
    import __spark_entry__ as entry

    result = compare(entry.queries()["op11_filter_interaction_audit"], ORACLE, spark, connect(FOLDER), FOLDER)
    assert result["ok"], result["why"]
