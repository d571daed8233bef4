"""Text helpers: emptiness, comma lists, packed `name=value` records, JSON fields."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def is_not_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) != ""


def trim_comma(c: Column) -> Column:
    """Strip commas from both ends and keep the rest."""
    return F.btrim(c, F.lit(","))


def two_digits(c: Column) -> Column:
    """Put one zero in front unless the text already has two characters."""
    return F.when(F.length(c) == 2, c).otherwise(F.concat(F.lit("0"), c))


def id_list(c: Column) -> Column:
    """Ids of a comma list; items that are not numbers are left out, null gives null."""
    ids = F.transform(F.split(c, ","), lambda item: item.try_cast("bigint"))
    return F.filter(ids, lambda i: i.isNotNull())


def packed_field(record: Column, delimiter: str, field: str) -> Column:
    """Value of the first `field=value` part of a packed record.

    Null when the field is missing or empty. Parts with more than one inner `=` are no fields.
    """
    d, name = re.escape(delimiter), re.escape(field)
    part = f"(?:^|{d}){name}=((?:(?!{d})[^=])+)=*(?={d}|$)"
    return F.nullif(F.regexp_extract(record, part, 1), F.lit(""))


def set_packed_field(record: Column, delimiter: str, field: str, value: Column | str) -> Column:
    """Replace the value of a field that exists; of repeated fields the last one stays."""
    new = F.lit(value) if isinstance(value, str) else value
    parts = F.split(record, re.escape(delimiter))

    def name(p: Column) -> Column:
        return F.substring_index(p, "=", 1)

    last_only = F.filter(
        parts,
        lambda p, i: ~F.exists(F.slice(parts, i + 2, F.size(parts)), lambda q: name(q) == name(p)),
    )
    replaced = F.transform(
        last_only,
        lambda p: F.when(name(p) == field, F.concat(F.lit(field + "="), new)).otherwise(p),
    )
    return F.array_join(replaced, delimiter)


def json_field(json: Column, field: str) -> Column:
    """Field of a JSON text as text; null for a missing field or text that is not JSON."""
    return F.get_json_object(json, f"$.{field}")


def id_and_name(id_: Column, name: Column, separator: str = ":") -> Column:
    return F.concat_ws(separator, id_.cast("string"), name)


def distinct_list(c: Column) -> Column:
    """Aggregate: the distinct values, sorted and joined by commas; null when there are none."""
    values = F.array_sort(F.collect_set(c))
    return F.nullif(F.array_join(F.transform(values, lambda v: v.cast("string")), ","), F.lit(""))
