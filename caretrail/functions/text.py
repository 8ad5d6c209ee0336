"""Text helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_part(text: Column, delimiter: str, position: int) -> Column:
    """The position-th part, an empty text when there are fewer."""
    return F.coalesce(F.try_element_at(F.split(text, _literal(delimiter)), F.lit(position)), F.lit(""))


def _literal(text: str) -> str:
    return "\\Q" + text + "\\E"


def title_case(text: Column) -> Column:
    """Lower case, with the first letter or digit after any punctuation or blank capitalised."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"""([^ ()\[\]{},.\-_'!@;:?/]+|[ ()\[\]{},.\-_'!@;:?/]+)"""), 1)
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, F.lit(2), F.length(w)))), "")


def full_name(*parts: Column) -> Column:
    """Parts joined by single blanks; a missing part leaves its blank, as the source's names do."""
    out = F.coalesce(parts[0], F.lit(""))
    for p in parts[1:]:
        out = F.concat(out, F.lit(" "), F.coalesce(p, F.lit("")))
    return out


def filing_id(identifier: Column) -> Column:
    """Digit pairs of a nine-digit identifier from its end, then its first digit: the order paper files are shelved in."""
    pairs = [F.substring(identifier, start, 2) for start in (8, 6, 4, 2)]
    return F.concat_ws("-", *pairs, F.substring(identifier, 1, 1))


def null_if_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def site_from_identifier(identifier: Column, prefixes: dict[str, str], default: str = "unknown") -> Column:
    """Site named by the first two letters of an identifier."""
    head = F.upper(F.substring(identifier, 1, 2))
    out = F.when(F.lit(False), F.lit(""))
    for prefix, site in prefixes.items():
        out = out.when(head == prefix, F.lit(site))
    return out.otherwise(F.lit(default))


def whole_word(text: Column, *words: str) -> Column:
    return text.rlike(r"\b(" + "|".join(words) + r")\b")
