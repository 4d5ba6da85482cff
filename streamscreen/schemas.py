"""Declared row types of every stream and table, and the validation rules of the JSON events."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import types as T


def _struct(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


_S, _I, _L, _D, _B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()

HEADERS = T.ArrayType(_struct(("key", _S), ("value", T.BinaryType())))

TOPIC_RECORD = _struct(
    ("key", T.BinaryType()), ("value", T.BinaryType()), ("topic", _S), ("partition", _I),
    ("offset", _L), ("timestamp", T.TimestampType()), ("timestampType", _I), ("headers", HEADERS),
)

PERSON_EVENT = _struct(("event_id", _L), ("name", _S), ("age", _L), ("ts_utc", _S))

APP_USER = _struct(("user_id", _S), ("name", _S), ("age", _I))

PAYMENT = _struct(
    ("event_id", _S), ("card_id", _S), ("user_id", _S), ("merchant_id", _S),
    ("merchant_category", _S), ("amount", _D), ("currency", _S), ("country", _S),
    ("ip_country", _S), ("channel", _S), ("ts_utc", _S),
)

WEATHER = _struct(
    ("city", _S), ("state", _S), ("latitude", _D), ("longitude", _D), ("timestamp", _S),
    ("temperature_f", _I), ("temperature_c", _D), ("temperature_unit", _S), ("wind_speed", _S),
    ("wind_direction", _S), ("short_forecast", _S), ("detailed_forecast", _S),
    ("is_daytime", _B), ("period_name", _S), ("icon", _S),
)

IOT_SENSOR = _struct(
    ("sensor_id", _S), ("location", _S), ("state", _S), ("latitude", _D), ("longitude", _D),
    ("timestamp", _S), ("temperature_celsius", _D), ("temperature_fahrenheit", _D),
    ("humidity_percent", _D), ("pressure_hpa", _D), ("air_quality_index", _I),
    ("air_quality_status", _S),
)

ENV_USER = _struct(
    ("user_id", _I), ("username", _S), ("email", _S), ("city", _S), ("state", _S),
    ("latitude", _D), ("longitude", _D), ("created_at", _L),
)

TRANSACTION = _struct(
    ("transaction_id", _S), ("customer_id", _S), ("amount", _D), ("merchant", _S),
    ("city", _S), ("event_time", _L), ("hour", _I),
)

ALERT = _struct(
    ("transaction_id", _S), ("customer_id", _S), ("amount", _D), ("city", _S),
    ("event_time", _L), ("rule_id", _S), ("rule_name", _S), ("risk_score", _D),
    ("details", _S), ("alert_time", _L),
)

FORECAST_DOCUMENT = _struct(
    ("properties", _struct(
        ("periods", T.ArrayType(_struct(
            ("name", _S), ("temperature", _D), ("temperatureUnit", _S), ("windSpeed", _S),
            ("windDirection", _S), ("shortForecast", _S), ("detailedForecast", _S),
            ("isDaytime", _B), ("icon", _S),
        ))),
    )),
)


@dataclass(frozen=True)
class Field:
    """One property of a JSON event: its type and the limits on its value; an object has fields of its own."""

    name: str
    kind: str  # "string", "number", "integer", "boolean" or "object"
    minimum: float | None = None
    min_length: int | None = None
    one_of: tuple[str, ...] = ()
    required: bool = True
    fields: tuple[Field, ...] = ()
    #: Whether an object may have no other keys.
    closed: bool = True


@dataclass(frozen=True)
class EventRules:
    """A JSON object: its typed columns, its fields, and whether other keys are refused."""

    schema: T.StructType
    fields: tuple[Field, ...] = field(default_factory=tuple)
    closed: bool = True


# The published constraints of the two validated event types, as JSON-Schema text.
PERSON_SCHEMA = """{
  "type": "object", "additionalProperties": false,
  "required": ["event_id", "name", "age", "ts_utc"],
  "properties": {
    "event_id": {"type": "integer", "minimum": 1}, "name": {"type": "string", "minLength": 1},
    "age": {"type": "integer", "minimum": 0}, "ts_utc": {"type": "string"}}}"""

PAYMENT_SCHEMA = """{
  "type": "object", "additionalProperties": false,
  "required": ["event_id", "card_id", "user_id", "merchant_id", "merchant_category", "amount", "currency", "country",
               "ip_country", "channel", "ts_utc"],
  "properties": {
    "event_id": {"type": "string"}, "card_id": {"type": "string"}, "user_id": {"type": "string"},
    "merchant_id": {"type": "string"}, "merchant_category": {"type": "string"}, "amount": {"type": "number", "minimum": 0},
    "currency": {"type": "string"}, "country": {"type": "string"}, "ip_country": {"type": "string"},
    "channel": {"type": "string", "enum": ["POS", "ECOM", "ATM"]}, "ts_utc": {"type": "string"}}}"""

_COLUMN_TYPES = {"string": _S, "number": _D, "integer": _L, "boolean": _B}
#: Keywords without a meaning for validation, and those understood for each type.
_NOTES = {"$schema", "$id", "$comment", "title", "description", "examples", "default"}
_KEYWORDS = {"string": {"minLength", "enum"}, "number": {"minimum"}, "integer": {"minimum"}, "boolean": set(),
             "object": {"properties", "required", "additionalProperties"}}


def _refuse(node: dict, kind: str, where: str) -> None:
    unknown = sorted(set(node) - _NOTES - {"type"} - _KEYWORDS[kind])
    if unknown:
        raise ValueError(f"{where}: keyword {unknown[0]!r} is not understood for type {kind!r}")


def _object(node: dict, where: str) -> tuple[tuple[Field, ...], T.StructType, bool]:
    _refuse(node, "object", where)
    properties, required = node.get("properties", {}), node.get("required", [])
    for name in required:
        if name not in properties:
            raise ValueError(f"{where}: required property {name!r} is not described")
    others = node.get("additionalProperties", True)
    if not isinstance(others, bool):
        raise ValueError(f"{where}: keyword 'additionalProperties' is understood as true or false only")
    fields, columns = [], []
    for name, own in properties.items():
        at = f"{where}.{name}"
        kind = own.get("type")
        if kind not in _KEYWORDS:
            raise ValueError(f"{at}: type {kind!r} is not understood")
        if not name.isidentifier():
            raise ValueError(f"{at}: the name is not an identifier")
        if kind == "object":
            inner, column, closed = _object(own, at)
            fields.append(Field(name, kind, required=name in required, fields=inner, closed=closed))
        else:
            _refuse(own, kind, at)
            if not all(isinstance(v, str) for v in own.get("enum", [])):
                raise ValueError(f"{at}: keyword 'enum' is understood for strings only")
            column = _COLUMN_TYPES[kind]
            fields.append(Field(name, kind, own.get("minimum"), own.get("minLength"), tuple(own.get("enum", ())), name in required))
        columns.append((name, column))
    return tuple(fields), _struct(*columns), not others


def rules_from(text: str) -> EventRules:
    """The rules that a JSON-Schema document states, with the columns of a valid event.

    Understood are objects (nested ones too) with ``properties``, ``required`` and ``additionalProperties``, and strings,
    numbers, integers and booleans with ``minimum``, ``minLength`` and ``enum``. Anything else is refused by name rather than ignored.
    """
    node = json.loads(text)
    if not isinstance(node, dict) or node.get("type") != "object":
        raise ValueError("the document does not describe an object")
    fields, schema, closed = _object(node, "$")
    return EventRules(schema, fields, closed)


PERSON_RULES, PAYMENT_RULES = rules_from(PERSON_SCHEMA), rules_from(PAYMENT_SCHEMA)
