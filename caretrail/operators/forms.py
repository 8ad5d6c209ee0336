"""Datasets of clinical forms: one job, many specs.

A spec lists the columns of a form as lines `column concept answers`. Answers are numbered by their order unless a line
says `code=number`. `yesno` is 1 and 0, `num` a number, `date` the first
day given, `day` the first day of asking, `text` all values joined. Where a visit has several of a
question's answers, the one listed first counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caretrail.functions.obs import SEPARATOR, lenient_number
from caretrail.operators.timeline import Timeline, following, next_where, prev, prev_where

YES, NO = 1065, 1066


@dataclass(frozen=True)
class Question:
    column: str
    concept: int
    kind: str  # coded | num | date | day | text
    answers: tuple[tuple[int, int], ...] = ()  # (code, number), first match counts


@dataclass(frozen=True)
class Form:
    name: str
    encounter_types: tuple[int, ...]
    questions: tuple[Question, ...]


# What every form is asked beside its own questions.
RETURN_DAY = Question("return_on", 5096, "date")


def parse_question(line: str) -> Question:
    column, concept, *answers = line.split()
    if answers in (["num"], ["date"], ["day"], ["text"]):
        return Question(column, int(concept), answers[0])
    if answers == ["yesno"]:
        return Question(column, int(concept), "coded", ((YES, 1), (NO, 0)))
    pairs = []
    for position, answer in enumerate(answers, 1):
        code, _, number = answer.partition("=")
        pairs.append((int(code), int(number) if number else position))
    return Question(column, int(concept), "coded", tuple(pairs))


def form(name: str, encounter_types: tuple[int, ...], *blocks: str) -> Form:
    lines = [line for block in blocks for line in block.strip().splitlines() if line.strip()]
    return Form(name, encounter_types, tuple(parse_question(line) for line in lines))


def read_form(path: str, name: str, encounter_types: tuple[int, ...]) -> Form:
    """A spec kept in a text file, for forms of other sites."""
    with open(path, encoding="utf-8") as lines:
        return form(name, encounter_types, lines.read())


def _column(q: Question) -> Column:
    here = F.col("concept_id") == q.concept
    value = F.col("value")
    if q.kind == "num":
        return F.min(F.when(here, lenient_number(value)))
    if q.kind == "date":
        return F.min(F.when(here, F.try_to_date(value, "yyyy-MM-dd")))
    if q.kind == "day":
        return F.min(F.when(here, F.col("obs_date")))
    if q.kind == "text":
        joined = F.array_join(F.array_sort(F.collect_list(F.when(here, value))), SEPARATOR)
        return F.nullif(joined, F.lit(""))
    rank: dict[str, int] = {}
    for i, (code, _) in enumerate(q.answers):
        rank.setdefault(str(code), i)
    table = F.create_map(*[F.lit(x) for pair in rank.items() for x in pair])
    best = F.min(F.when(here, F.try_element_at(table, value)))
    numbers = F.array(*[F.lit(number) for _, number in q.answers])
    return F.get(numbers, best)


def form_answers(tall: DataFrame, spec: Form, key: list[str]) -> DataFrame:
    """One row per key with the form's columns: one scan of its concepts and one aggregation."""
    concepts = sorted({q.concept for q in spec.questions})
    rows = tall.filter(F.col("concept_id").isin(concepts))
    return rows.groupBy(*key).agg(*[_column(q).alias(q.column) for q in spec.questions])


def form_timeline(df: DataFrame, line: Timeline) -> DataFrame:
    """Neighbouring forms of the patient, and neighbouring clinical ones with where they were and the return date they gave."""
    clinical = F.col("is_clinical") == 1
    return line.scan(
        df,
        prev_encounter_date=prev(F.col("encounter_date")),
        prev_encounter_type=prev(F.col("encounter_type")),
        next_encounter_date=following(F.col("encounter_date")),
        next_encounter_type=following(F.col("encounter_type")),
        prev_clinical_date=prev_where(clinical, F.col("encounter_date")),
        next_clinical_date=next_where(clinical, F.col("encounter_date")),
        prev_clinical_location_id=prev_where(clinical, F.col("location_id")),
        next_clinical_location_id=next_where(clinical, F.col("location_id")),
        prev_clinical_rtc_date=prev_where(clinical, F.col(RETURN_DAY.column)),
        next_clinical_rtc_date=next_where(clinical, F.col(RETURN_DAY.column)),
    )
