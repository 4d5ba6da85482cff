"""JSON validation: closed event types and card transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamscreen.functions.once import once
from streamscreen.schemas import EventRules, Field

_END = "end"


def with_document(df: DataFrame, text: Column) -> DataFrame:
    """Add ``_doc``, a VARIANT holding the JSON document of ``text`` as ``$.doc``, and ``_whole``, its
    type text; both are null or lack the end mark unless all of ``text`` is one JSON document.

    A JSON reader stops after the first document. Wrapped in an object with an end mark, anything
    left over is a syntax error or hides the mark. Of repeated keys the last one counts; the session is set to read
    them so, as it would refuse them otherwise.
    """
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    wrapped = F.concat(F.lit('{"doc":'), text, F.lit(f',"end":"{_END}"}}'))
    return once(once(df, _doc=F.try_parse_json(wrapped)), _whole=F.schema_of_variant("_doc"))


def _is_object() -> Column:
    return F.col("_whole").rlike("^OBJECT<doc: OBJECT<.*>, end: STRING>$")


def _member(document: Column, name: str, kind: str = "variant") -> Column:
    return F.try_variant_get(document, f"$.doc.{name}", kind)


# How each JSON type reads in the type text of a VARIANT.
_TYPE_TEXT = {"string": "STRING", "number": r"(?:BIGINT|DECIMAL\(\d+,\d+\)|DOUBLE)", "boolean": "BOOLEAN"}
_TYPE_TEXT["integer"] = _TYPE_TEXT["number"]
# Integers are read as decimals, which keep every digit of an id.
_READ_AS = {"string": "string", "number": "double", "integer": "decimal(38,10)", "boolean": "boolean"}
#: Parts a path of names; a dot may stand in a key.
_STEP = "\x01"


def _shape(fields: tuple[Field, ...]) -> str:
    """The type text of a closed object with these fields, as a pattern; its keys stand in order."""
    parts = []
    for f in sorted(fields, key=lambda f: f.name):
        kind = _shape(f.fields) if f.kind == "object" else _TYPE_TEXT[f.kind]
        parts.append(f"(?:{f.name}: {kind}(?:, |(?=>)))" + ("" if f.required else "?"))
    return "OBJECT<" + "".join(parts) + ">"


def _all_closed(fields: tuple[Field, ...], closed: bool) -> bool:
    return closed and all(_all_closed(f.fields, f.closed) for f in fields if f.kind == "object")


def _read_type(fields: tuple[Field, ...]) -> str:
    return "struct<" + ",".join(
        f"{f.name}:{_read_type(f.fields) if f.kind == 'object' else _READ_AS[f.kind]}" for f in fields) + ">"


def _every(fields: tuple[Field, ...], above: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], Field]]:
    """All fields with their paths, an object before its own."""
    out = []
    for f in fields:
        path = (*above, f.name)
        out.append((path, f))
        out += _every(f.fields, path)
    return out


def _limits(rule: Field, value: Column, shown: str, present: Column) -> list[Column]:
    """Broken limits of a value of the right type; a field that is not there breaks none."""
    out = []
    if rule.kind == "integer":
        out.append(F.when(value != F.floor(value), F.lit(f"'{shown}' is not of type integer")))
    if rule.minimum is not None:
        out.append(F.when(value < rule.minimum,
                          F.lit(f"'{shown}' is less than the minimum of {rule.minimum}")))
    if rule.kind == "integer":
        # A number too large for the decimal reads as null.
        out.append(F.when(present & value.try_cast("bigint").isNull(), F.lit(f"'{shown}' does not fit 64 bits")))
    if rule.min_length is not None:
        out.append(F.when(F.length(value) < rule.min_length, F.lit(f"'{shown}' is too short")))
    if rule.one_of:
        out.append(F.when(~value.isin(*rule.one_of),
                          F.lit(f"'{shown}' is not one of {list(rule.one_of)}")))
    return out


def _present(path: tuple[str, ...], rules: EventRules) -> Column:
    """Whether a field is there, where that is not sure already."""
    fields, optional = rules.fields, False
    for name in path:
        own = next(f for f in fields if f.name == name)
        fields, optional = own.fields, optional or not own.required
    return _member(F.col("_doc"), ".".join(path)).isNotNull() if optional else F.lit(True)


def _keyed(path: tuple[str, ...]) -> Column:
    """An object of the document as a map; null if it is none."""
    return F.try_variant_get("_doc", ".".join(("$.doc", *path)), "map<string,variant>")


def _closed_objects(rules: EventRules) -> list[tuple[tuple[str, ...], tuple[Field, ...]]]:
    """Paths and fields of the objects that may have no other keys, from the top."""
    objects = [((), rules.fields, rules.closed)] + [(path, f.fields, f.closed) for path, f in _every(rules.fields) if f.kind == "object"]
    return [(path, fields) for path, fields, closed in objects if closed]


def _types(rules: EventRules) -> Column:
    """The type text of every key of the document and of its described objects, by path."""
    def of(above: tuple[str, ...]) -> Column:
        whole = _keyed(above)
        prefix = F.lit(_STEP.join((*above, "")))
        own = F.transform_keys(whole, lambda k, _: F.concat(prefix, k)) if above else whole
        return F.coalesce(F.transform_values(own, lambda _, v: F.schema_of_variant(v)), F.create_map().cast("map<string,string>"))

    objects = [path for path, f in _every(rules.fields) if f.kind == "object"]
    return F.map_concat(of(()), *map(of, objects)) if objects else of(())


def _misfits(rules: EventRules) -> Column:
    """For each field what is wrong with its type in ``_types``, or null."""
    wanted = F.array(*[F.struct(F.lit(_STEP.join(path)).alias("path"), F.lit(".".join(path)).alias("name"), F.lit(f.kind).alias("kind"),
                                F.lit(f.required).alias("required"), F.lit(_STEP.join(path[:-1])).alias("above"))
                       for path, f in _every(rules.fields)])

    def of_field(field: Column) -> Column:
        found = F.try_element_at(F.col("_types"), field["path"])
        number = found.isin("BIGINT", "DOUBLE") | found.startswith("DECIMAL(")
        fits = (F.when(field["kind"] == "string", found == "STRING").when(field["kind"] == "boolean", found == "BOOLEAN")
                .when(field["kind"] == "object", found.startswith("OBJECT<")).otherwise(number))
        inside = (field["above"] == "") | F.coalesce(
            F.try_element_at(F.col("_types"), field["above"]).startswith("OBJECT<"), F.lit(False))
        missing = found.isNull() & field["required"] & inside
        return (F.when(missing, F.concat(F.lit("'"), field["name"], F.lit("' is a required property")))
                .when(~fits, F.concat(F.lit("'"), field["name"], F.lit("' is not of type "), field["kind"])))

    return F.transform(wanted, of_field)


def _keys_below(prefix: str) -> Column:
    """The keys of an object in ``_types``, without those of the objects in it."""
    rest = F.lit(len(prefix) + 1)
    keys = F.filter(F.map_keys("_types"), lambda k: k.startswith(prefix) & ~F.substr(k, rest).contains(_STEP))
    return F.transform(keys, lambda k: F.substr(k, rest))


def _each_below(names: Column, prefix: str) -> Column:
    return F.transform(names, lambda k: F.concat(F.lit(prefix), k))


def _extra(text: Column, rules: EventRules) -> list[Column]:
    """For each closed object the complaint about keys that are not described."""
    out = []
    for path, fields in _closed_objects(rules):
        own = _keys_below(_STEP.join((*path, "")) if path else "")
        # At the top in the order of the document.
        in_order = F.when(F.size(own) > len(fields), F.json_object_keys(text))
        found = in_order if not path and all(f.required for f in fields) else own
        extra = F.array_except(found, F.array(*[F.lit(f.name) for f in fields]).cast("array<string>"))
        shown = F.array_join(_each_below(extra, ".".join((*path, "")) if path else ""), ", ")
        out.append(F.when(F.size(extra) > 0, F.concat(F.lit("additional properties are not allowed: "), shown)))
    return out


def _first_problem(text: Column, rules: EventRules) -> Column:
    """The first problem of an object whose keys or types are wrong, from ``_misfit`` and the values of limited fields."""
    out = []
    for i, (path, rule) in enumerate(_every(rules.fields)):
        own = F.get("_misfit", F.lit(i))
        out.append(own)
        if rule.kind != "object":
            value = _member(F.col("_doc"), ".".join(path), _READ_AS[rule.kind])
            there = F.try_element_at(F.col("_types"), F.lit(_STEP.join(path))).isNotNull()
            out += [F.when(own.isNull(), broken) for broken in _limits(rule, value, ".".join(path), there)]
    return F.coalesce(*out, *_extra(text, rules), F.lit("a number is out of range"))


def _fits(rules: EventRules) -> Column:
    """Whether keys and types are the expected ones: by the type text of the whole document, or field by field if keys may be added."""
    if _all_closed(rules.fields, rules.closed):
        return F.col("_whole").rlike("^OBJECT<doc: " + _shape(rules.fields) + ", end: STRING>$")
    out = _is_object()
    for path, f in _every(rules.fields):
        found = F.schema_of_variant(_member(F.col("_doc"), ".".join(path)))
        if f.kind == "object":
            kind = "^" + _shape(f.fields) + "$" if _all_closed(f.fields, f.closed) else "^OBJECT<"
        else:
            kind = f"^{_TYPE_TEXT[f.kind]}$"
        above = _member(F.col("_doc"), ".".join(path[:-1])).isNull() if len(path) > 1 else F.lit(False)
        out = out & F.coalesce(found.rlike(kind), F.lit(not f.required) | above)
    for path, fields in _closed_objects(rules):
        keys = F.map_keys(_keyed(path))
        other = F.array_except(keys, F.array(*[F.lit(f.name) for f in fields]).cast("array<string>"))
        out = out & F.coalesce(F.size(other) == 0, F.lit(True))
    return out


def _typed_rows(df: DataFrame, text: Column, rules: EventRules) -> DataFrame:
    """Add ``_row``: the typed fields of a document whose keys and types are the expected ones, else null."""
    return once(with_document(df, text), _row=F.when(_fits(rules), F.try_variant_get("_doc", "$.doc", _read_type(rules.fields))))


def _broken(rules: EventRules) -> Column:
    """The first broken limit of ``_row``; null if all hold."""
    out = []
    for path, f in _every(rules.fields):
        if f.kind != "object":
            value = F.col("_row")
            for name in path:
                value = value[name]
            out += _limits(f, value, ".".join(path), _present(path, rules))
    return F.coalesce(*out, F.lit(None).cast("string"))


def _event(rules: EventRules) -> list[Column]:
    def typed(value: Column, f: Field, kind: T.DataType) -> Column:
        if f.kind != "object":
            return value.try_cast(kind).alias(f.name)
        inner = F.struct(*[typed(value[g.name], g, kind[g.name].dataType) for g in f.fields])
        return F.when(value.isNotNull(), inner).alias(f.name)

    return [typed(F.col("_row")[f.name], f, rules.schema[f.name].dataType) for f in rules.fields]


def check(df: DataFrame, text: Column, rules: EventRules) -> DataFrame:
    """Add ``event`` (typed struct, null if invalid) and ``error`` (the first problem, or null).

    Types are exact: a quoted number or a null is not a number, and an integer may be written ``1.0``.
    The type text of a whole document tells at once whether its keys and types are the expected
    ones; only documents that fail this are taken apart for the message. No document ends the job.
    """
    whole, row = F.col("_whole"), F.col("_row")
    typed = once(_typed_rows(df, text, rules), _types=F.when(row.isNull() & _is_object(), _types(rules)))
    # A column of its own, as every field looks into it.
    typed = once(typed, _misfit=F.when(F.col("_types").isNotNull(), _misfits(rules)))
    judged = once(typed, error=(
        F.when(row.isNotNull(), _broken(rules))
        .when(whole.isNull() | ~whole.endswith(", end: STRING>"), F.lit("not a JSON document"))
        .when(~_is_object(), F.lit("not of type object"))
        .otherwise(_first_problem(text, rules))))
    return judged.select(*df.columns, F.when(F.col("error").isNull(), F.struct(*_event(rules))).alias("event"), "error")


def valid_only(df: DataFrame, text: Column, rules: EventRules) -> DataFrame:
    """The typed fields of the valid documents, as ``valid_events(check(...))`` gives them, without making messages."""
    typed = _typed_rows(df, text, rules)
    return typed.where(F.col("_row").isNotNull() & _broken(rules).isNull()).select(*_event(rules))


def check_records(records: DataFrame, rules: EventRules) -> DataFrame:
    """Validate the JSON value of topic records."""
    return check(records, F.col("value").cast("string"), rules)


def check_rows(df: DataFrame, rules: EventRules) -> DataFrame:
    """Validate typed rows before they are written, by the same rules as on reading."""
    names = [f.name for f in rules.fields]
    return check(df, F.to_json(F.struct(*names)), rules)


def valid_events(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("error").isNull()).select("event.*")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("error").isNotNull()).drop("event")


#: Times whose differences and look-backs stay within 64 bits, and the end of the year 9999.
MAX_TIME_MS = 4_000_000_000_000_000_000
CALENDAR_MS = 253_402_300_799_999
# The keys that a transaction must have.
REQUIRED_TRANSACTION_KEYS = ("transaction_id", "customer_id", "amount", "event_time")


def parse_transactions(df: DataFrame, text: Column, record_timestamp: Column | None = None) -> DataFrame:
    """Card transactions from JSON text; malformed or incomplete rows are dropped.

    The four required keys must be present. ``merchant`` and ``city`` default to "", ``hour`` to 0.
    Numbers may be quoted. ``event_ts`` is the event time, or ``record_timestamp`` where the event
    time cannot be read or is no time of a calendar; a row whose ``event_time`` or ``hour`` is unreadable, or whose
    ``event_time`` is beyond ``MAX_TIME_MS``, has ``complete`` false and only counts in the spend window.
    """
    doc = F.col("_doc")
    fields = ("transaction_id", "customer_id", "amount", "merchant", "city", "event_time", "hour")
    record_ts = F.lit(None).cast("timestamp") if record_timestamp is None else record_timestamp
    parsed = with_document(df.withColumn("_record_ts", record_ts), F.trim(text))
    present = _is_object()
    for name in REQUIRED_TRANSACTION_KEYS:
        present = present & _member(doc, name).isNotNull()

    def or_default(name: str, kind: str, default: object) -> Column:
        return F.when(_member(doc, name).isNull(), F.lit(default)).otherwise(_member(doc, name, kind))

    values = once(
        parsed.where(present),
        transaction_id=_member(doc, "transaction_id", "string"),
        customer_id=_member(doc, "customer_id", "string"), amount=_member(doc, "amount", "double"),
        merchant=or_default("merchant", "string", ""), city=or_default("city", "string", ""),
        event_time=_member(doc, "event_time", "bigint"), hour=or_default("hour", "int", 0))
    ms = F.col("event_time")
    at = F.coalesce(F.when(F.abs(F.when(ms > -MAX_TIME_MS, ms)) <= CALENDAR_MS, F.timestamp_millis(ms)), F.col("_record_ts"))
    return (values.where(F.col("customer_id").isNotNull() & F.col("amount").isNotNull())
            .select(*fields, at.alias("event_ts"),
                    (F.coalesce(ms.between(-MAX_TIME_MS, MAX_TIME_MS), F.lit(False)) & F.col("hour").isNotNull())
                    .alias("complete")))
