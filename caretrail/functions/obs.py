"""Reading answers out of an event's observations.

Events carry their observations as `map<concept, array<struct<value, date>>>`. The `!!concept=value!!` strings are an
output format; the string readers below exist for data that only has those.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = " ## "


class Answers:
    """Typed access to one answers map column."""

    def __init__(self, column: str = "answers"):
        self.map = F.col(column)

    def asked(self, *concepts: int) -> Column:
        """Any of the concepts has an observation."""
        out = F.map_contains_key(self.map, F.lit(concepts[0]))
        for c in concepts[1:]:
            out = out | F.map_contains_key(self.map, F.lit(c))
        return F.coalesce(out, F.lit(False))

    def said(self, concept: int | tuple, *codes: int) -> Column:
        """The concept (or one of several) was answered with one of the codes, compared as whole codes."""
        concepts = concept if isinstance(concept, tuple) else (concept,)
        wanted = F.array(*[F.lit(str(c)) for c in codes])
        out = None
        for c in concepts:
            hit = F.arrays_overlap(self.values(c), wanted)
            out = hit if out is None else (F.coalesce(out, F.lit(False)) | F.coalesce(hit, F.lit(False)))
        return F.coalesce(out, F.lit(False))

    def entries(self, concept: int) -> Column:
        return F.try_element_at(self.map, F.lit(concept))

    def values(self, concept: int) -> Column:
        return F.transform(self.entries(concept), lambda e: e["value"])

    def first(self, concept: int) -> Column:
        """First value in the order of the encoded string."""
        return F.get(self.entries(concept), F.lit(0))["value"]

    def joined(self, concept: int) -> Column:
        """All values of a concept, separator-joined; null when there are none."""
        return F.array_join(self.values(concept), SEPARATOR)

    def first_date(self, concept: int) -> Column:
        """Date on which the concept was observed."""
        return F.get(self.entries(concept), F.lit(0))["date"]

    def number(self, concept: int) -> Column:
        return lenient_number(self.first(concept))

    def is_number(self, concept: int) -> Column:
        return F.coalesce(self.first(concept).rlike(r"^[0-9]"), F.lit(False))

    def date(self, concept: int) -> Column:
        """The answer itself read as a date."""
        return F.try_to_date(self.first(concept), "yyyy-MM-dd")

    def map_codes(self, table: list[tuple[int | tuple, tuple, object]]) -> Column:
        """First matching row of (concept or concepts, codes, result); empty codes mean any answer."""
        out = None
        for concept, codes, result in table:
            test = self.said(concept, *codes) if codes else self.asked(*(concept if isinstance(concept, tuple) else (concept,)))
            out = F.when(test, F.lit(result)) if out is None else out.when(test, F.lit(result))
        return out


def lenient_number(text: Column, to: str = "double") -> Column:
    """Leading number of a text, as a lenient cast gives it; null when there is none."""
    return F.nullif(F.regexp_extract(text, r"^\s*(-?\d+(?:\.\d+)?)", 1), F.lit("")).try_cast(to)


# Readers for encoded strings


def encoded_has(obs: Column, concept: int | str) -> Column:
    return F.contains(obs, F.lit(f"!!{concept}="))


def encoded_said(obs: Column, concepts: list, codes: list) -> Column:
    return obs.rlike(f"!!({'|'.join(map(str, concepts))})=({'|'.join(map(str, codes))})!!")


def encoded_first(obs: Column, concept: int | str) -> Column:
    return F.nullif(F.regexp_extract(obs, rf"!!{concept}=(.*?)!!", 1), F.lit(""))


def encoded_values(obs: Column, concept: int | str) -> Column:
    """All values of a concept as an array, empty when there are none."""
    return F.regexp_extract_all(obs, F.lit(rf"!!{concept}=(.*?)!!"), 1)


def encoded_joined(obs: Column, concept: int | str) -> Column:
    return F.nullif(F.array_join(encoded_values(obs, concept), SEPARATOR), F.lit(""))


def encoded_custom(obs: Column, key: str) -> Column:
    """As `encoded_joined` for text keys, but an empty text when there are none."""
    return F.array_join(encoded_values(obs, key), SEPARATOR)


def encoded_is_number(obs: Column, concept: int) -> Column:
    return obs.rlike(f"!!{concept}=[0-9]")


def encoded_answers(obs: Column) -> Column:
    """Parse an encoded string back to (concept, value) pairs."""
    return F.transform(
        F.filter(F.split(obs, SEPARATOR), lambda t: t.rlike("^!!.+=")),
        lambda t: F.struct(
            F.regexp_extract(t, "^!!(.+?)=", 1).alias("concept"), F.regexp_extract(t, "=(.*)!!$", 1).alias("value")
        ),
    )
