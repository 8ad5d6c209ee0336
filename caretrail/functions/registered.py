"""SQL functions for users who write SQL: plain SQL bodies that Spark inlines, no Python at run time."""

from __future__ import annotations

from pyspark.sql import SparkSession

from caretrail.functions.regimens import ADULT_CODES, CHEMO, CHILD_CODES, COMBINATIONS, COMPONENTS, INFANT_PROPHYLAXIS, NAME_EXCEPTIONS


def _texts(codes) -> str:
    return "array(" + ", ".join(f"'{c}'" for c in codes) + ")"


def _regimen(codes: str, named: bool) -> str:
    parts = []
    for code, name, members in COMPONENTS:
        if named:
            members = [m for m in members if m not in NAME_EXCEPTIONS.get(code, ())]
        parts.append(f"CASE WHEN arrays_overlap({codes}, {_texts(members)}) THEN '{name if named else code}' END")
    return f"nullif(array_join(array({', '.join(parts)}), ' ## '), '')"


def _map(table: dict) -> str:
    return "map(" + ", ".join(f"'{k}', {v if isinstance(v, str) and v.startswith('array') else repr(v)}" for k, v in table.items()) + ")"


def _present(codes: str, needs, without) -> str:
    test = " AND ".join(f"array_contains({codes}, '{n}')" for n in needs)
    return f"{test} AND NOT arrays_overlap({codes}, {_texts(without)})" if without else test


ANSWERS = "regexp_extract_all(obs, concat('!!', question, '=(.*?)!!'), 1)"
_COMBINED = _map({k: "array(" + ", ".join(map(str, v)) + ")" for k, v in COMBINATIONS.items()})
_CHEMO = ", ".join(f"CASE WHEN {_present(ANSWERS, needs, without)} THEN '{name}' END" for name, needs, without in CHEMO)

FUNCTIONS = {
    "split_str(x STRING, delim STRING, pos INT) RETURNS STRING": "coalesce(try_element_at(split(x, concat('\\\\Q', delim, '\\\\E')), pos), '')",
    "get_values(obs STRING, concept INT) RETURNS STRING": "nullif(array_join(regexp_extract_all(obs, concat('!!', concept, '=(.*?)!!'), 1), ' ## '), '')",
    "get_custom_values(obs STRING, key STRING) RETURNS STRING": "array_join(regexp_extract_all(obs, concat('!!', key, '=(.*?)!!'), 1), ' ## ')",
    "normalize_arvs(obs STRING, question STRING) RETURNS STRING": _regimen(ANSWERS, False),
    "get_arv_names(concepts STRING) RETURNS STRING": _regimen("split(concepts, ' ## ')", True),
    "convert_to_title_case(str STRING) RETURNS STRING": r"""array_join(transform(
        regexp_extract_all(lower(str), '([^ ()\\[\\]{},.\\-_\'!@;:?/]+|[ ()\\[\\]{},.\\-_\'!@;:?/]+)', 1),
        w -> concat(upper(substring(w, 1, 1)), substring(w, 2))), '')""",
    "replace_arv_concept_ids(codes STRING) RETURNS STRING": f"""array_join(transform(array_sort(array_distinct(flatten(transform(
        split(codes, ' ## '), c -> coalesce(try_element_at({_COMBINED}, c), array(try_cast(c AS INT))))))), c -> string(c)), ' ## ')""",
    "get_arv_concept_ids(obs STRING, concept INT) RETURNS STRING": "replace_arv_concept_ids(get_values(obs, concept))",
    "get_moh_arv_code(concepts STRING, age INT, line INT) RETURNS STRING": f"""CASE
        WHEN age >= 12 THEN coalesce(try_element_at({_map(ADULT_CODES)}, concepts), 'adult unknown')
        WHEN age < 12 THEN coalesce(try_element_at({_map(CHILD_CODES)}, concepts), 'peds unknown') END""",
    "normalize_arvs_drug_formulation(obs STRING) RETURNS STRING": "concat('1088=', nullif(get_custom_values(obs, '1088_drug'), ''))",
    "normalize_chemo_drugs(obs STRING, question STRING) RETURNS STRING": f"nullif(array_join(array({_CHEMO}), ' ## '), '')",
    "normalize_pmtct_arvs(obs STRING, question STRING) RETURNS STRING": f"nullif(array_join(array_intersect({_texts(INFANT_PROPHYLAXIS)}, {ANSWERS}), ' ## '), '')",
}


def register(spark: SparkSession) -> None:
    """Make the functions callable by name in this session."""
    for head, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
