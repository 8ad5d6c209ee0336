"""Drug codes: expansion of combination codes, names and national regimen codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caretrail.functions.obs import SEPARATOR
from caretrail.functions.text import null_if_empty

# For every component drug, its short name and the codes that contain it. The order is the order of
# the components in a regimen text.
COMPONENTS: list[tuple[int, str, tuple[int, ...]]] = [
    (625, "d4T", (6965, 792, 625)),
    (628, "3TC", (6467, 1400, 630, 6679, 6965, 9050, 817, 9052, 792, 628, 6964, 10268, 9051)),
    (631, "NVP", (631, 6467, 9050, 6095, 792)),
    (633, "EFV", (633, 6964, 9053, 9052)),
    (635, "NFV", (635,)),
    (749, "IDV", (749,)),
    (791, "FTC", (791, 6180, 9435)),
    (795, "RTV", (795, 9051, 9905, 6160, 794, 9055)),
    (796, "DDI", (796,)),
    (797, "AZT", (6467, 630, 797, 817, 9053, 9615, 8588, 8587)),
    (802, "TDF", (6964, 1400, 6180, 8435, 802, 9055, 10268)),
    (814, "ABC", (9051, 6679, 814, 9050, 817)),
    (6156, "RAL", (6156,)),
    (6157, "DRV", (6157,)),
    (6158, "ETR", (6158,)),
    (6159, "ATV", (6159, 6160)),
    (9026, "LOP", (9051, 9026, 794, 9055)),
    (9759, "DTG", (9759, 10268)),
    (10090, "RPV", (10090, 9435)),
    (5424, "UNKNOWN DRUG", (5424, 5811)),
]

# Codes that contain a component when answered but do not name it. 3TC is not read from 6964, 10268 and
# 9051, TDF not from 10268, DTG not from 10268, and the unknown drug not from 5811.
NAME_EXCEPTIONS = {628: (6964, 10268, 9051), 802: (10268,), 9759: (10268,), 5424: (5811,)}

# Combination codes and the components that replace them in a code list.
COMBINATIONS: dict[int, tuple[int, ...]] = {
    630: (797, 628),
    792: (625, 628, 631),
    794: (9026, 795),
    1400: (628, 802),
    6160: (6159, 795),
    6180: (791, 802),
    6467: (631, 628, 797),
    6964: (802, 628, 633),
    6965: (628, 625),
    6679: (814, 628),
    9435: (791, 802),
}

# National regimen codes by component list, from age 12 on and below.
ADULT_CODES: dict[str, str] = {
    "628 ## 631 ## 797": "AF1A",
    "628 ## 633 ## 797": "AF1B",
    "628 ## 631 ## 802": "AF2A",
    "628 ## 633 ## 802": "AF2B",
    "625 ## 628 ## 631": "AF3A",
    "625 ## 628 ## 633": "AF3B",
    "628 ## 631 ## 814": "AF4A",
    "628 ## 633 ## 814": "AF4B",
    "628 ## 795 ## 814 ## 9026": "AS1A",
    "628 ## 795 ## 797 ## 6159": "AS1B",
    "628 ## 795 ## 802 ## 9026": "AS2A",
    "628 ## 795 ## 802 ## 6159": "AS2C",
    "628 ## 795 ## 814 ## 6159": "AS5B",
    "628 ## 795 ## 6156 ## 6157": "AT1A",
    "628 ## 795 ## 797 ## 6156 ## 6157": "AT1B",
    "628 ## 795 ## 802 ## 6156 ## 6157": "AT1C",
    "628 ## 795 ## 6157 ## 6158": "AT2A",
}
CHILD_CODES: dict[str, str] = {
    "628 ## 631 ## 797": "CF1A",
    "628 ## 633 ## 797": "CF1B",
    "628 ## 795 ## 797 ## 9026": "CF1C",
    "628 ## 795 ## 797 ## 6159": "CF1D",
    "628 ## 631 ## 814": "CF2A",
    "628 ## 633 ## 814": "CF2B",
    "628 ## 795 ## 814 ## 9026": "CF2D",
    "628 ## 795 ## 814 ## 6159": "CF2E",
    "625 ## 628 ## 631": "CF3A",
    "625 ## 628 ## 633": "CF3B",
    "628 ## 631 ## 802": "CF4A",
    "628 ## 633 ## 802": "CF4B",
    "628 ## 795 ## 802 ## 9026": "CF4C",
    "628 ## 795 ## 802 ## 6159": "CF4D",
    "628 ## 795 ## 6156 ## 6157": "CT1A",
    "628 ## 795 ## 797 ## 6156 ## 6157": "CT1B",
    "628 ## 795 ## 814 ## 6156 ## 6157": "CT1C",
    "628 ## 795 ## 6157 ## 6158": "CT2A",
}

# ARV line by drug code.
LINE_CODES: list[tuple[int, tuple[int, ...]]] = [
    (1, (6467, 6964, 792, 633, 631, 9759)),
    (2, (794, 635, 6160, 6159)),
    (3, (6156,)),
]

# Chemotherapy regimens by required drugs, with drugs that rule a regimen out.
CHEMO: list[tuple[str, tuple[int, ...], tuple[int, ...]]] = [
    ("MP", (7213, 491), (8486,)),
    ("MPV", (7213, 491, 8486), ()),
    ("VRD", (8486, 8480, 7207), ()),
    ("VTD", (8486, 8479, 7207), ()),
    ("VD", (8486, 7207), ()),
    ("VMD", (8486, 7213, 7207), ()),
    ("RD", (8480, 7207), ()),
    ("TD", (8479, 7207), ()),
    ("RCD", (8480, 7203, 7207), ()),
    ("RTD", (8480, 8479, 7207), ()),
]

# Infant prophylaxis answers, in output order.
INFANT_PROPHYLAXIS = (9615, 8523, 9614, 9506)


def _texts(codes) -> Column:
    return F.array(*[F.lit(str(c)) for c in codes])


def components_of(codes: Column) -> Column:
    """Component drugs of an array of drug codes (as texts), in regimen order; null when none is known."""
    parts = F.array(*[F.when(F.arrays_overlap(codes, _texts(has)), F.lit(str(code))) for code, _, has in COMPONENTS])
    return null_if_empty(F.array_join(parts, SEPARATOR))


def expand_combinations(codes: Column) -> Column:
    """Distinct component codes of all codes, in numeric order, joined as one text."""
    table = F.create_map(*[x for k, v in COMBINATIONS.items() for x in (F.lit(str(k)), F.array(*[F.lit(c) for c in v]))])
    single = lambda c: F.coalesce(F.try_element_at(table, c), F.array(c.try_cast("int")))
    flat = F.flatten(F.transform(codes, single))
    return F.array_join(F.transform(F.array_sort(F.array_distinct(flat)), lambda c: c.cast("string")), SEPARATOR)


def drug_names(regimen: Column) -> Column:
    """Short names of the drugs in a regimen text, in regimen order."""
    codes = F.split(regimen, SEPARATOR)
    parts = []
    for code, name, has in COMPONENTS:
        named = [c for c in has if c not in NAME_EXCEPTIONS.get(code, ())]
        parts.append(F.when(F.arrays_overlap(codes, _texts(named)), F.lit(name)))
    return null_if_empty(F.array_join(F.array(*parts), SEPARATOR))


def national_code(regimen: Column, age: Column) -> Column:
    """National code of an exact component list."""

    def look_up(table: dict[str, str], other: str) -> Column:
        entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
        return F.coalesce(F.try_element_at(entries, regimen), F.lit(other))

    return F.when(age >= 12, look_up(ADULT_CODES, "adult unknown")).when(age < 12, look_up(CHILD_CODES, "peds unknown"))


def formulation(values: Column) -> Column:
    """Formulation text of the drug names answered to one question, null when there are none."""
    return F.when(F.size(values) > 0, F.concat(F.lit("1088="), F.array_join(values, SEPARATOR)))


def chemo_regimens(drugs: Column) -> Column:
    """Names of the chemotherapy regimens whose drugs are all present."""
    parts = []
    for name, needs, without in CHEMO:
        test = F.forall(_texts(needs), lambda d: F.array_contains(drugs, d))
        if without:
            test = test & ~F.arrays_overlap(drugs, _texts(without))
        parts.append(F.when(test, F.lit(name)))
    return null_if_empty(F.array_join(F.array(*parts), SEPARATOR))


def infant_prophylaxis(codes: Column) -> Column:
    return null_if_empty(F.array_join(F.array_intersect(_texts(INFANT_PROPHYLAXIS), codes), SEPARATOR))


def arv_line(codes: Column) -> Column:
    """Treatment line of an array of drug codes (as texts)."""
    out = F.when(F.lit(False), F.lit(0))
    for line, members in LINE_CODES:
        out = out.when(F.arrays_overlap(codes, _texts(members)), F.lit(line))
    return out


def regimen_text(present: list[tuple[str, Column]]) -> tuple[Column, Column]:
    """Dash-joined names of the drugs taken, and how many they are."""
    names = F.array(*[F.when(taken, F.lit(name)) for name, taken in present])
    return F.array_join(names, "-"), F.size(F.array_compact(names))
