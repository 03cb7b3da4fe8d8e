"""Semi-structured flattening of the event document.

The payload is parsed **once** per row with ``from_json`` against a schema that
contains exactly the leaves a caller asks for; every leaf is read as STRING
(so numbers and numeric strings both survive) and cast afterwards with
``try_cast`` (``on_error="null"``) or ``cast`` (``"fail"``).  First array
elements are read with ``get(arr, 0)``, which yields NULL on empty arrays
instead of raising under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# FIXED VALUES: output column -> (path in the event document, type).  Integers
# in a path are array positions.
PAYLOAD_PATHS: dict[str, tuple[tuple, str]] = {
    "event_name": (("name",), "string"),
    "event_url": (("url",), "string"),
    "event_date": (("dates", "start", "localDate"), "date"),
    "event_time": (("dates", "start", "localTime"), "string"),
    "event_datetime_utc": (("dates", "start", "dateTime"), "timestamp_ntz"),
    "event_status": (("dates", "status", "code"), "string"),
    "genre": (("classifications", 0, "genre", "name"), "string"),
    "sub_genre": (("classifications", 0, "subGenre", "name"), "string"),
    "venue_id": (("_embedded", "venues", 0, "id"), "string"),
    "venue_name": (("_embedded", "venues", 0, "name"), "string"),
    "venue_city": (("_embedded", "venues", 0, "city", "name"), "string"),
    "venue_state_code": (("_embedded", "venues", 0, "state", "stateCode"), "string"),
    "venue_country_code": (("_embedded", "venues", 0, "country", "countryCode"), "string"),
    "venue_address": (("_embedded", "venues", 0, "address", "line1"), "string"),
    "venue_latitude": (("_embedded", "venues", 0, "location", "latitude"), "double"),
    "venue_longitude": (("_embedded", "venues", 0, "location", "longitude"), "double"),
    "artist_id": (("_embedded", "attractions", 0, "id"), "string"),
    "artist_name": (("_embedded", "attractions", 0, "name"), "string"),
    "price_min": (("priceRanges", 0, "min"), "double"),
    "price_max": (("priceRanges", 0, "max"), "double"),
    "price_currency": (("priceRanges", 0, "currency"), "string"),
}

ALL_FIELDS = list(PAYLOAD_PATHS)


def payload_schema(fields: Sequence[str]) -> T.StructType:
    """Minimal nested schema covering ``fields``; every leaf is a string."""
    tree: dict = {}
    for name in fields:
        node = tree
        for step in PAYLOAD_PATHS[name][0]:
            if isinstance(step, int):
                node = node.setdefault("[]", {})
            else:
                node = node.setdefault(step, {})
    return _to_type(tree)


def _to_type(node: dict) -> T.DataType:
    if not node:
        return T.StringType()
    if "[]" in node:
        return T.ArrayType(_to_type(node["[]"]))
    return T.StructType([T.StructField(k, _to_type(v)) for k, v in node.items()])


def path_value(doc: Column, name: str) -> Column:
    """Leaf ``name`` of a parsed document, still as text."""
    c = doc
    for step in PAYLOAD_PATHS[name][0]:
        c = F.get(c, step) if isinstance(step, int) else c.getField(step)
    return c


def typed_value(doc: Column, name: str, on_error: str = "null") -> Column:
    target = PAYLOAD_PATHS[name][1]
    raw = path_value(doc, name)
    if target == "string":
        return raw
    return raw.cast(target) if on_error == "fail" else raw.try_cast(target)


@lru_cache(maxsize=None)
def _field_of_doc(name: str, on_error: str) -> Column:
    """``typed_value`` of the parsed ``_doc`` column, built once per process."""
    return typed_value(F.col("_doc"), name, on_error).alias(name)


def parse_payload(payload: Column, fields: Sequence[str], on_error: str = "null") -> Column:
    opts = {"mode": "FAILFAST"} if on_error == "fail" else {"mode": "PERMISSIVE"}
    return F.from_json(payload, payload_schema(fields), opts)


def flatten(raw: DataFrame, fields: Sequence[str] | None = None, on_error: str = "null",
            keep: Sequence[str] = ("event_id", "fetched_city", "ingested_at"),
            keep_payload: bool = False) -> DataFrame:
    """Typed columns for ``fields`` next to the ``keep`` columns.

    Malformed text yields all-NULL fields in ``"null"`` mode and fails the
    task in ``"fail"`` mode.
    """
    fields = list(fields or ALL_FIELDS)
    if set(fields) <= set(raw.columns):
        # already flattened (a typed table written once per run): no parsing
        return raw.select(*keep, *fields, *(["payload"] if keep_payload else []))
    doc = parse_payload(F.col("payload"), fields, on_error)
    staged = raw.select(*keep, *(["payload"] if keep_payload else []), doc.alias("_doc"))
    cols = [F.col(k) for k in keep]
    cols += [_field_of_doc(f, on_error) for f in fields]
    if keep_payload:
        cols.append(F.col("payload"))
    return staged.select(*cols)


def json_valid(payload: Column) -> Column:
    """Does the text parse as JSON (``try_parse_json`` is not NULL)."""
    return F.try_parse_json(payload).isNotNull()


def variant_value(payload: Column, path: str, type_: str = "string") -> Column:
    """Ad-hoc path outside ``PAYLOAD_PATHS`` through VARIANT (Spark 4.x).

    ``path`` is a JSON path such as ``"$._embedded.venues[0].timezone"``; the
    text is parsed with ``try_parse_json`` (malformed -> NULL) and the leaf is
    read with ``try_variant_get`` (missing or uncastable -> NULL).  A JSON
    ``null`` leaf also gives NULL for typed reads, matching ``flatten``.
    """
    return F.try_variant_get(F.try_parse_json(payload), path, type_)


# ---- VARIANT: parsed once when stored, read path by path -----------------------------


def variant_rows(raw: DataFrame, on_error: str = "null", keep: Sequence[str] = ("event_id", "fetched_city", "ingested_at")) -> DataFrame:
    """``keep`` columns and ``doc``, the payload as VARIANT, to be stored.

    ``on_error="fail"`` uses the raising ``parse_json``; else malformed text is NULL.
    """
    if on_error not in ("null", "fail"):
        raise ValueError(f"on_error must be null or fail, not {on_error!r}")
    parse = F.parse_json if on_error == "fail" else F.try_parse_json
    return raw.select(*keep, parse(F.col("payload")).alias("doc"))


def variant_path(name: str) -> str:
    """JSON path of ``name``, e.g. ``$._embedded.venues[0].id``."""
    return "$" + "".join(f"[{step}]" if isinstance(step, int) else f".{step}" for step in PAYLOAD_PATHS[name][0])


def flatten_variant(rows: DataFrame, fields: Sequence[str] | None = None,
                    keep: Sequence[str] = ("event_id", "fetched_city", "ingested_at")) -> DataFrame:
    """X1-X6 from ``doc``: same columns and values as ``flatten``; the text is not parsed again."""
    def leaf(name: str) -> Column:
        text = F.try_variant_get("doc", variant_path(name), "string")
        target = PAYLOAD_PATHS[name][1]
        return (text if target == "string" else text.try_cast(target)).alias(name)

    return rows.select(*keep, *(leaf(f) for f in fields or ALL_FIELDS))
