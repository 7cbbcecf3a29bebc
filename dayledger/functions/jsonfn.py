"""JSON payload helpers (FN-19, PII-03) on JSON text columns, JVM-side.

Spark has no ``jsonb``; payloads stay text and are parsed by built-ins
(``json_object_keys``, ``get_json_object``, ``from_json``, ``parse_json``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def json_keys(payload: Column | str) -> Column:
    """Top-level keys of a JSON object; NULL for arrays, scalars and bad JSON.
    Keys whose value is JSON null are listed."""
    return F.json_object_keys(_c(payload))


def json_type(payload: Column | str) -> Column:
    """``jsonb_typeof``: object / array / string / number / boolean / null."""
    t = F.upper(F.schema_of_variant(F.try_parse_json(_c(payload))))
    return (F.when(t.startswith("OBJECT"), "object")
            .when(t.startswith("ARRAY"), "array")
            .when(t == "STRING", "string")
            .when(t == "BOOLEAN", "boolean")
            .when(t.isin("VOID", "NULL"), "null")
            .when(t.isNotNull(), "number"))


def json_has_key(payload: Column | str, key: str) -> Column:
    """``payload ? key``: an object with that top-level key, or an array holding
    that string. NULL payload gives NULL (so ``NOT`` of it filters the row)."""
    p = _c(payload)
    in_object = F.array_contains(F.json_object_keys(p), F.lit(key))
    in_array = F.array_contains(F.from_json(p, "array<string>"), F.lit(key))
    return (F.when(p.isNull(), F.lit(None).cast("boolean"))
            .when(in_object.isNotNull(), in_object)
            .when(F.json_array_length(p).isNotNull(), F.coalesce(in_array, F.lit(False)))
            .otherwise(F.lit(False)))


def _path(keys: Sequence[str]) -> str:
    return "$" + "".join("['" + k.replace("'", "\\'") + "']" for k in keys)


def json_text(payload: Column | str, *keys: str) -> Column:
    """``payload -> k1 -> ... ->> kn``: text of the value at a key path; NULL when
    absent (a JSON null also reads NULL)."""
    return F.get_json_object(_c(payload), _path(keys))


def json_strip_keys(payload: Column | str, keys: Sequence[str]) -> Column:
    """PII-03 ``payload - 'key'`` on objects only; arrays, scalars, NULL unchanged.

    The object is read as ``map<string, variant>`` so nested values survive
    the round trip unchanged in structure.
    """
    p = _c(payload)
    banned = F.array(*[F.lit(k) for k in keys])
    as_map = F.from_json(p, "map<string,variant>")
    stripped = F.to_json(F.map_filter(as_map, lambda k, v: ~F.array_contains(banned, k)))
    return F.when(F.json_object_keys(p).isNotNull(), stripped).otherwise(p)
