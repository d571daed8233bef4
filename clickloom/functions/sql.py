"""The text and time helpers as SQL functions, for reports that are written as SQL text.

`register` makes them temporary functions of a session. Their bodies are SQL, which the optimizer
inlines, so a query that calls them has the plan of one that spells them out: nothing leaves the JVM.
They give what the column functions of the same names in `texts`, `times` and `numbers` give.

SQL functions cannot aggregate; `distinct_list` takes what `collect_set` has gathered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

from clickloom.session import pin_utc
from clickloom.sources.cities import AREA_LEVELS, OTHER_LEVEL

_PARTS = r"split(record, concat('\\Q', delimiter, '\\E'))"

# Name with parameters, result type, body.
FUNCTIONS: tuple[tuple[str, str, str], ...] = (
    ("is_empty(value STRING)", "BOOLEAN", "coalesce(value, '') = ''"),
    ("is_not_empty(value STRING)", "BOOLEAN", "coalesce(value, '') <> ''"),
    ("trim_comma(value STRING)", "STRING", "trim(BOTH ',' FROM value)"),
    ("two_digits(value STRING)", "STRING", "if(length(value) = 2, value, concat('0', value))"),
    ("id_and_name(id BIGINT, name STRING, separator STRING)", "STRING",
     "concat_ws(separator, CAST(id AS STRING), name)"),
    ("json_field(json STRING, field STRING)", "STRING", "get_json_object(json, concat('$.', field))"),
    ("distinct_list(gathered ARRAY<STRING>)", "STRING",
     "nullif(array_join(array_sort(array_distinct(gathered)), ','), '')"),
    ("packed_field(record STRING, delimiter STRING, field STRING)", "STRING",
     f"""get(filter(transform(
            filter({_PARTS}, part -> startswith(part, concat(field, '='))),
            part -> rtrim('=', substring(part, length(field) + 2))),
          value -> value <> '' AND instr(value, '=') = 0), 0)"""),
    ("set_packed_field(record STRING, delimiter STRING, field STRING, value STRING)", "STRING",
     f"""array_join(transform(
            filter({_PARTS}, (part, i) -> NOT exists(
                slice({_PARTS}, i + 2, size({_PARTS})),
                later -> substring_index(later, '=', 1) = substring_index(part, '=', 1))),
            part -> if(substring_index(part, '=', 1) = field, concat(field, '=', value), part)),
          delimiter)"""),
    ("date_key(at TIMESTAMP)", "STRING", "date_format(at, 'yyyyMMdd')"),
    ("minute_key(at TIMESTAMP)", "STRING", "date_format(at, 'yyyyMMddHHmm')"),
    ("product_status(extend_info STRING)", "STRING",
     "if(get_json_object(extend_info, '$.product_status') = '0', 'Self', 'Third Party')"),
)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register(
    spark: SparkSession, levels: Mapping[str, Sequence[str]] = AREA_LEVELS
) -> SparkSession:
    """Make the functions callable in the session's SQL; `area_level(area)` knows the given levels."""
    cases = " ".join(
        f"WHEN {_literal(area)} THEN {_literal(level)}" for level, areas in levels.items() for area in areas
    )
    level = ("area_level(area STRING)", "STRING", f"CASE area {cases} ELSE {_literal(OTHER_LEVEL)} END")
    for signature, kind, body in (*FUNCTIONS, level):
        pin_utc(spark).sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {kind} RETURN {body}")
    return spark
