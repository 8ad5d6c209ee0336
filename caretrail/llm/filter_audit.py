"""Audit of how text filters interact: what each removes, alone and behind the others, in every order.

A document's failures are one number, a bit a filter. The filter on repeated texts is an existential self-join: a left semi
join of the documents with the least id of each repeated text, on hash, exact text and smaller id. Its ids are joined to the
failures of the other filters by a union, and one aggregate counts the combinations of bits by part. There are at most 32 of them a
part, and all orders and steps follow from them without going back to the documents.

Defined results: null and empty texts are the same text, of no words; it fails A, and E beside a smaller id. A null doc_id is
neither smaller than another nor has one; it carries no label. Rows of one doc_id and text are counted one by one and are not copies of
each other, and rows of one doc_id with different texts are judged apart. A doc_id with several labels counts as good or toxic if one of
them says so. A null part is the empty string. No documents give no rows. Only the named columns of the documents are read, so further ones cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"  # fixed: what ends a word
FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
REPEATED = 16  # the bit of E


def text_failures(text: Column) -> Column:
    """The bits of the four filters that need one text only."""
    words = F.array_remove(F.split(text, SPACE), "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [
        F.size(words) < 50,
        100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
        100 * capitals.cast("long") > 5 * F.length(text).cast("long"),
        text.rlike(r"[#$%&*|]"),
    ]
    return sum((F.when(fail, 1 << i).otherwise(0) for i, fail in enumerate(fails)), F.lit(0))


def repeated_ids(docs: DataFrame) -> DataFrame:
    """(doc_id, part, hash, size) of the rows whose text a smaller doc_id has too: E.

    Only texts that share hash and size with one of another id travel, the least id of each exact text once.
    """
    shared = docs.groupBy("hash", "size").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    close = docs.join(shared.select("hash", "size"), ["hash", "size"], "left_semi")
    first = close.groupBy("hash", "text").agg(F.min("doc_id").alias("least"))
    d, s = close.alias("d"), first.alias("s")
    same = (F.col("d.hash") == F.col("s.hash")) & (F.col("d.text") == F.col("s.text")) & (F.col("s.least") < F.col("d.doc_id"))
    return d.join(s, same, "left_semi").select("doc_id", "part", "hash", "size")


def failure_combinations(documents: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """(part, bits, n, good, toxic): how many documents of a part fail just these filters, and how many of them are good and toxic."""
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(part, F.lit("")).alias("part"))
    docs = docs.select("*", F.xxhash64("text").alias("hash"), F.octet_length("text").alias("size"))
    key = ["doc_id", "part", "hash", "size"]
    alone = docs.select(*key, text_failures(F.col("text")).alias("bits"), F.lit(1).cast("long").alias("n"))
    marked = repeated_ids(docs).select(*key, F.lit(REPEATED).alias("bits"), F.lit(0).cast("long").alias("n"))
    judged = alone.unionByName(marked).groupBy(*key).agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    label = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")
    )
    of = lambda name: F.sum(F.col("n") * F.coalesce(name, F.lit(0))).alias(name)
    return judged.join(label, "doc_id", "left").groupBy("part", "bits").agg(F.sum("n").alias("n"), of("good"), of("toxic"))


def _steps() -> Column:
    """All orders and steps: the step's bit and the bits of the filters before it."""
    bit = {f: 1 << i for i, f in enumerate(FILTERS)}
    rows = [(order, i + 1, bit[f], sum(bit[g] for g in order[:i])) for order in ORDERS for i, f in enumerate(order)]
    return F.expr("array(" + ",".join(f"struct('{o}' as filter_order, {s} as step, {b} as bit, {p} as before)" for o, s, b, p in rows) + ")")


def interactions(combinations: DataFrame) -> DataFrame:
    """A row per part, order of the filters and step, from the at most 32 combinations of the part."""
    parts = combinations.groupBy("part").agg(F.collect_list(F.struct("bits", "n", "good", "toxic")).alias("combos"))
    steps = parts.select("part", "combos", F.explode(_steps()).alias("s")).select("part", "combos", "s.*")
    bit, before = F.col("bit"), F.col("before")
    has = lambda bits, mask: bits.bitwiseAND(mask) != 0

    def total(test: Callable[[Column], Column], value: Callable[[Column], Column] = lambda c: c["n"]) -> Column:
        chosen = F.filter("combos", lambda c: test(c["bits"]))
        return F.aggregate(chosen, F.lit(0).cast("long"), lambda sum_, c: sum_ + value(c))

    removed = lambda bits: has(bits, bit) & ~has(bits, before)
    return steps.select(
        "part",
        "filter_order",
        "step",
        total(lambda bits: ~has(bits, bit.bitwiseOR(before))).alias("kept"),
        total(removed).alias("removed"),
        total(lambda bits: has(bits, bit) & has(bits, before)).alias("redundant"),
        total(lambda bits: bits == bit).alias("unique_fails"),
        total(removed, lambda c: c["good"]).alias("good_lost"),
        total(removed, lambda c: c["toxic"]).alias("toxic_lost"),
        # Of all orders, each failed filter comes first in an equal share.
        total(lambda bits: has(bits, bit), lambda c: c["n"] * (len(ORDERS) / F.bit_count(c["bits"])).cast("long")).alias("shapley"),
    )


def filter_audit(documents: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    return interactions(failure_combinations(documents, labels, part))


# In its own words: every order is walked step by step, and shapley is summed over all of them.
ORACLE = r"""
with docs as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text, coalesce(source, '') as part from documents),
words as (select *, [w for w in string_split_regex(text, '[\x20\x09-\x0D]+') if w <> ''] as w from docs),
marks as (
  select r, part,
    len(w) < 50 as a,
    100 * len(list_distinct(w)) < 65 * len(w) as b,
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) as c,
    regexp_matches(text, '[#$%&*|]') as d,
    coalesce(doc_id > min(doc_id) over (partition by text), false) as e,
    exists (select 1 from labels l where l.doc_id = words.doc_id and l.quality = 1) as good,
    exists (select 1 from labels l where l.doc_id = words.doc_id and l.toxic = 1) as toxic
  from words),
combos as (
  select part, (case when a then 'A' else '' end) || (case when b then 'B' else '' end) || (case when c then 'C' else '' end)
    || (case when d then 'D' else '' end) || (case when e then 'E' else '' end) as fails,
    count(*) as n, sum(good::int) as good, sum(toxic::int) as toxic
  from marks group by 1, 2),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
  select p.x || q.x || s.x || t.x || u.x as o from letters p, letters q, letters s, letters t, letters u
  where len(list_distinct([p.x, q.x, s.x, t.x, u.x])) = 5),
steps as (select o, s.i as step, substr(o, s.i, 1) as f, substr(o, 1, s.i - 1) as before from orders, (select unnest(range(1, 6)) as i) s),
walked as (
  select part, o, step, f, n, good, toxic, fails,
    contains(fails, f) as hit, len(list_intersect(string_split(fails, ''), string_split(before, ''))) > 0 and fails <> '' and before <> '' as gone
  from combos, steps),
counted as (
  select part, o, step, f,
    coalesce(sum(n) filter (not hit and not gone), 0) as kept, coalesce(sum(n) filter (hit and not gone), 0) as removed,
    coalesce(sum(n) filter (hit and gone), 0) as redundant, coalesce(sum(n) filter (fails = f), 0) as unique_fails,
    coalesce(sum(good) filter (hit and not gone), 0) as good_lost, coalesce(sum(toxic) filter (hit and not gone), 0) as toxic_lost
  from walked group by 1, 2, 3, 4)
select part, o as filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
  unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
  (sum(removed) over (partition by part, f))::bigint as shapley
from counted
"""
