"""Event facts: typed columns read from tall observations by conditional aggregation.

A fact says what to read about an event: whether a question was asked or answered with given codes, its code, number,
date or day, or the set of component drugs among its codes. All facts of a dataset are one partial aggregate on fixed
width buffers: nothing is collected, repeated answers merge map-side, and only the concepts needed are scanned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caretrail.functions.obs import SEPARATOR, lenient_number
from caretrail.functions.regimens import COMPONENTS
from caretrail.functions.text import null_if_empty

Fact = tuple  # (kind, concepts, codes)


def said(concepts, *codes: int) -> Fact:
    return ("said", concepts if isinstance(concepts, tuple) else (concepts,), codes)


def asked(*concepts: int) -> Fact:
    return ("asked", concepts, ())


def code(concept: int) -> Fact:
    return ("code", (concept,), ())


def number(concept: int) -> Fact:
    return ("number", (concept,), ())


def date(concept: int) -> Fact:
    return ("date", (concept,), ())


def day(concept: int) -> Fact:
    return ("day", (concept,), ())


def drugs(concept: int) -> Fact:
    """Bit set of the component drugs in the codes of a question."""
    return ("drugs", (concept,), ())


def concepts_of(facts: dict[str, Fact]) -> list[int]:
    return sorted({c for _, concepts, _ in facts.values() for c in concepts})


def _drug_bits(value: Column) -> Column:
    bits: dict[int, int] = {}
    for i, (_, _, members) in enumerate(COMPONENTS):
        for m in members:
            bits[m] = bits.get(m, 0) | (1 << i)
    table = F.create_map(*[F.lit(x) for m, b in bits.items() for x in (str(m), b)])
    return F.coalesce(F.try_element_at(table, value), F.lit(0))


def regimen_of_bits(bits: Column) -> Column:
    """Regimen text of a drug bit set."""
    parts = [F.when(bits.bitwiseAND(1 << i) != 0, F.lit(str(c))) for i, (c, _, _) in enumerate(COMPONENTS)]
    return null_if_empty(F.array_join(F.array(*parts), SEPARATOR))


FLAGS_PER_COLUMN = 62


def _flag_names(facts: dict[str, Fact]) -> list[str]:
    return [n for n, (kind, _, _) in facts.items() if kind in ("said", "asked")]


def _flag_tables(facts: dict[str, Fact]) -> tuple[list[tuple], list[tuple], int]:
    """Flag bits raised by a concept alone, and by a concept with a code."""
    names = _flag_names(facts)
    words = -(-len(names) // FLAGS_PER_COLUMN)
    by_concept: dict[int, list[int]] = {}
    by_code: dict[tuple[int, str], list[int]] = {}
    for i, name in enumerate(names):
        kind, concepts, codes = facts[name]
        word, bit = divmod(i, FLAGS_PER_COLUMN)
        for c in concepts:
            if kind == "asked":
                by_concept.setdefault(c, [0] * words)[word] |= 1 << bit
            else:
                for k in codes:
                    by_code.setdefault((c, str(k)), [0] * words)[word] |= 1 << bit
    return [(c, *m) for c, m in by_concept.items()], [(c, k, *m) for (c, k), m in by_code.items()], words


def _value_aggregate(kind: str, concept: int) -> Column:
    asked_here = F.col("concept_id") == concept
    value = F.col("value")
    if kind == "code":
        return F.min(F.when(asked_here, value.try_cast("int")))
    if kind == "number":
        return F.min(F.when(asked_here, lenient_number(value)))
    if kind == "date":
        return F.min(F.when(asked_here, F.try_to_date(value, "yyyy-MM-dd")))
    if kind == "day":
        return F.min(F.when(asked_here, F.col("obs_date")))
    if kind == "drugs":
        return F.bit_or(F.when(asked_here, _drug_bits(value)))
    raise ValueError(kind)


def _literal_table(spark, rows: list[tuple], columns: list[str]) -> DataFrame:
    """A small table whose size is that of a fact list, so it may always be broadcast."""
    text = ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else f"{v}L" if i >= 1 else str(v) for i, v in enumerate(r)) + ")" for r in rows)
    return F.broadcast(spark.sql(f"SELECT * FROM VALUES {text} AS t({', '.join(columns)})"))


def extract_packed(tall: DataFrame, key: list[str], facts: dict[str, Fact]) -> DataFrame:
    """One row per key: flags packed in a few bit-set columns, and a column per valued fact.

    A row raises its flags through a lookup of its concept and code, so a hundred flags cost two joins with a table of
    the fact list and a few `bit_or` buffers, and they stay packed while rows move.
    """
    spark = tall.sparkSession
    by_concept, by_code, words = _flag_tables(facts)
    rows = tall.filter(F.col("concept_id").isin(concepts_of(facts)))
    masks = []
    if by_concept:
        names = [f"__a{i}" for i in range(words)]
        rows = rows.join(_literal_table(spark, by_concept, ["concept_id", *names]), "concept_id", "left")
        masks.append(names)
    if by_code:
        names = [f"__s{i}" for i in range(words)]
        rows = rows.join(_literal_table(spark, by_code, ["concept_id", "value", *names]), ["concept_id", "value"], "left")
        masks.append(names)
    flags = []
    for i in range(words):
        word = F.coalesce(F.col(masks[0][i]), F.lit(0).cast("bigint"))
        for more in masks[1:]:
            word = word.bitwiseOR(F.coalesce(F.col(more[i]), F.lit(0).cast("bigint")))
        flags.append(F.bit_or(word).alias(f"flags_{i}"))
    values = [
        _value_aggregate(kind, concepts[0]).alias(name)
        for name, (kind, concepts, _) in facts.items()
        if kind not in ("said", "asked")
    ]
    return rows.groupBy(*key).agg(*flags, *values)


def packed_columns(facts: dict[str, Fact]) -> list[str]:
    words = -(-len(_flag_names(facts)) // FLAGS_PER_COLUMN)
    return [f"flags_{i}" for i in range(words)]


def raised(facts: dict[str, Fact], name: str) -> Column:
    """A flag that is still packed is set; false for events without any observation."""
    word, bit = divmod(_flag_names(facts).index(name), FLAGS_PER_COLUMN)
    return F.coalesce(F.getbit(F.col(f"flags_{word}"), F.lit(bit)), F.lit(0)) == 1


def unpack(df: DataFrame, facts: dict[str, Fact]) -> DataFrame:
    """Flags as 0/1 columns; 0 for events without any observation."""
    columns = []
    for i, name in enumerate(_flag_names(facts)):
        word, bit = divmod(i, FLAGS_PER_COLUMN)
        columns.append(f"CAST(shiftright(coalesce(flags_{word}, 0L), {bit}) & 1L AS INT) AS {name}")
    kept = [c for c in df.columns if c not in packed_columns(facts)]
    return df.selectExpr(*kept, *columns)


def extract_facts(tall: DataFrame, key: list[str], facts: dict[str, Fact]) -> DataFrame:
    """One row per key with a column per fact."""
    return unpack(extract_packed(tall, key, facts), facts)


def fill_absent(df: DataFrame, facts: dict[str, Fact]) -> DataFrame:
    """Flags of events without any observation are 0, not null."""
    return df.fillna(0, _flag_names(facts))
