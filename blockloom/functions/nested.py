"""JSON text, arrays and maps whose keys are only known per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_array(text: Column) -> Column:
    """JSON list to ARRAY<STRING>; nested elements keep their JSON text."""
    return F.from_json(text, "array<string>")


def json_map(text: Column) -> Column:
    """JSON object to MAP<STRING,STRING> in key order; nested values stay JSON text."""
    return F.from_json(text, "map<string,string>")


def json_objects(text: Column, field: str) -> Column:
    """The list of objects under a key of a JSON document, each as MAP<STRING,STRING>.

    One typed pass over the text. Spark voids the whole document if a member
    is of another kind, so those rare documents are taken apart step by step.
    """
    typed = F.from_json(text, f"struct<{field}:array<map<string,string>>>")[field]
    stepwise = F.transform(json_array(lookup(json_map(text), F.lit(field))), json_map)
    return F.coalesce(typed, stepwise)


def json_objects_by_key(text: Column, field: str, member: str) -> Column:
    """The object of objects under a key as MAP<STRING, member type>, likewise."""
    typed = F.from_json(text, f"struct<{field}:map<string,{member}>>")[field]
    stepwise = F.transform_values(
        json_map(lookup(json_map(text), F.lit(field))), lambda _, value: F.from_json(value, member)
    )
    return F.coalesce(typed, stepwise)


def once(value: Column) -> Column:
    """``value`` as a generated column, for use in a select list.

    A plain column gets copied into every later filter, so an expensive
    parse would run again there; filters stay above a generator.
    """
    return F.explode(F.array(value))


def topic_at(topics: Column, position: int) -> Column:
    """Array element, NULL past the end."""
    return F.get(topics, F.lit(position))


def lookup(mapping: Column, key: Column) -> Column:
    """Map value under a per-row key, NULL if missing."""
    return F.try_element_at(mapping, key)


def first_value(mapping: Column) -> Column:
    return F.get(F.map_values(mapping), F.lit(0))


def whole_number(value: Column) -> Column:
    """Truncate towards zero to BIGINT; out of range or non-numeric is NULL.

    Whole and decimal texts are exact; only exponents go through DOUBLE.
    """
    text = F.trim(value.cast("string"))
    exact = F.when(text.rlike(r"^[+-]?[0-9]+([.][0-9]*)?$"), F.split_part(text, F.lit("."), F.lit(1)))
    return F.when(exact.isNotNull(), exact.try_cast("bigint")).otherwise(value.try_cast("double").try_cast("bigint"))


def without_keys(mapping: Column, names: list[str]) -> Column:
    """The map's other entries."""
    return F.map_filter(mapping, lambda key, _: ~key.isin(*names))
