import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from streamscreen import schemas
from streamscreen.operators import payments
from streamscreen.plans import payment_screening, people
from streamscreen.sources import relational, tabular, topics, validate
from tests.conftest import rows

BASE = {"event_id": "e", "card_id": "c1", "user_id": "u", "merchant_id": "m", "merchant_category": "BOOKS",
        "amount": 399.99, "currency": "CAD", "country": "CA", "ip_country": "CA", "channel": "POS",
        "ts_utc": "2024-01-01T00:00:00Z"}


def raw(spark, values, key=b"k1", headers=(("source", b"f"), ("excel_row", b"7"))):
    data = [(key, v if isinstance(v, bytes) else json.dumps(v).encode(), "payments.raw", 0, i, None, 0,
             [tuple(h) for h in headers] if headers is not None else None)
            for i, v in enumerate(values)]
    return spark.createDataFrame(data, schemas.TOPIC_RECORD)


def with_(**changes):
    return {**BASE, **changes}


def without(name):
    return {k: v for k, v in BASE.items() if k != name}


def test_scores_reasons_and_routes(spark):
    cases = [
        (with_(), 0, [], "payments.approved"),
        (with_(amount=400), 40, ["high_amount"], "payments.approved"),
        (with_(amount=400, ip_country="US"), 65, ["high_amount", "ip_country_mismatch"], "payments.flagged"),
        (with_(country="NG", ip_country="NG", merchant_category="CRYPTO"), 60,
         ["risky_country", "high_risk_category"], "payments.flagged"),
        (with_(country="RU"), 55, ["risky_country", "ip_country_mismatch"], "payments.approved"),
        (with_(channel="ATM", amount=199.99), 0, [], "payments.approved"),
        (with_(channel="ATM", amount=200), 20, ["large_atm_withdrawal"], "payments.approved"),
        (with_(amount=400, country="NG", merchant_category="GIFT_CARDS", channel="ATM"), 145,
         ["high_amount", "risky_country", "high_risk_category", "ip_country_mismatch", "large_atm_withdrawal"],
         "payments.flagged"),
    ]
    out = payment_screening.screen_records(raw(spark, [c[0] for c in cases])).collect()
    assert len(out) == len(cases)
    for record, (_, score, reasons, topic) in zip(out, cases):
        value = json.loads(bytes(record["value"]))
        assert (value["risk_score"], value["risk_reasons"], record["topic"]) == (score, reasons, topic)
        assert bytes(record["key"]) == b"k1"
        assert [(h["key"], bytes(h["value"])) for h in record["headers"]] == [
            ("source", b"f"), ("excel_row", b"7"), ("processed_by", b"payment-screening"),
            ("model", b"rules_v1"), ("routed_to", topic.encode())]


def test_zero_amount_gives_nothing(spark):
    assert payment_screening.screen_records(raw(spark, [with_(amount=0), with_(amount=0.0)])).count() == 0


BAD = [(with_(amount=-1), "'amount' is less than the minimum of 0"),
       (with_(channel="WEB"), "'channel' is not one of ['POS', 'ECOM', 'ATM']"),
       (without("card_id"), "'card_id' is a required property"),
       (with_(note="x"), "additional properties are not allowed: note"),
       (with_(amount="12"), "'amount' is not of type number"),
       (with_(amount=None), "'amount' is not of type number"),
       (with_(user_id=5), "'user_id' is not of type string"),
       (b"bad{", "not a JSON document"), (b'{"a":1} x', "not a JSON document"),
       (json.dumps(BASE).encode() + b"}", "not a JSON document"),
       (b"[1]", "not of type object"), (b"5", "not of type object"), (b"", "not a JSON document")]


def test_dead_letters(spark):
    out = payment_screening.screen_records(raw(spark, [b[0] for b in BAD])).collect()
    assert [r["topic"] for r in out] == ["payments.dlq"] * len(BAD)
    letters = [json.loads(bytes(r["value"])) for r in out]
    assert [x["error"] for x in letters] == [b[1] for b in BAD]
    assert letters[3] == {"error": BAD[3][1], "topic": "payments.raw", "partition": 0, "offset": 3,
                          "key": "k1", "excel_row": "7"}
    assert all(r["key"] is None for r in out)
    assert [(h["key"], bytes(h["value"])) for h in out[0]["headers"]] == [("source", b"f"), ("excel_row", b"7")]


def test_dead_letter_without_key_or_header(spark):
    letter = json.loads(bytes(payment_screening.screen_records(
        raw(spark, [b"bad{"], key=None, headers=None)).first()["value"]))
    assert (letter["key"], letter["excel_row"]) == ("", "")


def test_amount_not_numeric_letter_holds_the_event(spark):
    checked = validate.check_records(raw(spark, [with_()]), schemas.PAYMENT_RULES)
    broken = checked.withColumn("event", F.col("event").withField("amount", F.lit(None).cast("double")))
    letter = json.loads(bytes(payments.screen(broken).first()["value"]))
    assert letter["error"] == "amount not numeric" and letter["event"]["card_id"] == "c1"


def test_totals(spark):
    events = payment_screening.screen_events(raw(spark, [with_(), with_(amount=400), with_(amount=500, ip_country="US")]))
    assert rows(payments.totals_by_route(events)) == [("payments.approved", 2, 799.99), ("payments.flagged", 1, 500.0)]
    assert rows(payments.totals_by_reason(events)) == [("high_amount", 2, 900.0), ("ip_country_mismatch", 1, 500.0)]


def test_person_rules(spark):
    good = {"event_id": 1, "name": "Tom", "age": 29, "ts_utc": "t"}
    values = [good, {**good, "age": 1.0}, {**good, "event_id": 0}, {**good, "name": ""}, {**good, "age": -1},
              {**good, "age": "29"}, {k: v for k, v in good.items() if k != "ts_utc"}, {**good, "x": 1},
              {**good, "age": None}, {**good, "age": 1.5}]
    ok, bad = people.read_people(raw(spark, values, key=b"Tom", headers=None))
    assert rows(ok, "offset", "key", "name", "age") == [(0, "Tom", "Tom", 29), (1, "Tom", "Tom", 1)]
    assert [r["error"] for r in bad.orderBy("offset").collect()] == [
        "'event_id' is less than the minimum of 1", "'name' is too short", "'age' is less than the minimum of 0",
        "'age' is not of type integer", "'ts_utc' is a required property",
        "additional properties are not allowed: x", "'age' is not of type integer", "'age' is not of type integer"]


def test_large_numbers_keep_their_digits_or_are_rejected(spark):
    good = {"event_id": 1, "name": "Tom", "age": 29, "ts_utc": "t"}
    values = [{**good, "event_id": n} for n in (3_000_000_000, 2**53 + 1, 2**63 - 1, 2**63, 10**30)]
    values += [b'{"event_id":1e300,"name":"Tom","age":1,"ts_utc":"t"}', b'{"event_id":5,"event_id":6,"name":"Tom","age":1,"ts_utc":"t"}']
    ok, bad = people.read_people(raw(spark, values, key=b"Tom", headers=None))
    assert rows(ok, "offset", "event_id") == [(0, 3_000_000_000), (1, 2**53 + 1), (2, 2**63 - 1), (6, 6)]
    assert {r["error"] for r in bad.collect()} == {"'event_id' does not fit 64 bits"}


def test_problems_of_nested_and_missing_fields(spark):
    values = [with_(amount={"value": 1}), with_(channel=["POS"]), with_(amount=None), without("channel"),
              {**with_(channel="WEB"), "note": {"amount": 1}}, {**with_(amount="1"), "note": 1}, with_(amount=-1.0),
              {**BASE, "odd: STRING, channel": "x"}]
    got = validate.check_records(raw(spark, values), schemas.PAYMENT_RULES).orderBy("offset")
    assert [r["error"] for r in got.collect()] == [
        "'amount' is not of type number", "'channel' is not of type string", "'amount' is not of type number",
        "'channel' is a required property", "'channel' is not one of ['POS', 'ECOM', 'ATM']",
        "'amount' is not of type number", "'amount' is less than the minimum of 0",
        "additional properties are not allowed: odd: STRING, channel"]


def test_valid_rows_without_messages_are_the_valid_events(spark):
    records = raw(spark, [with_(), with_(amount=-1), with_(amount="1"), b"x", with_(channel="WEB"), with_(amount=7)])
    plain = validate.valid_events(validate.check_records(records, schemas.PAYMENT_RULES))
    quick = validate.valid_only(records, F.col("value").cast("string"), schemas.PAYMENT_RULES)
    assert quick.schema == plain.schema and rows(quick) == rows(plain) and quick.count() == 2


def test_only_new_rows_are_published(spark, tmp_path):
    topic, marks = topics.Topic("t", folder=str(tmp_path / "topics")), str(tmp_path / "marks")
    table = spark.createDataFrame([(i, f"n{i}") for i in range(6)], "id long, name string")

    def number(r):
        return topics.numbered(r, 2, F.lit(0), F.current_timestamp())

    def run(rows_):
        return relational.publish_new(spark, rows_, "t", "id", topic, marks, number=number)

    assert [run(table.where("id < 0")), run(table.where("id < 3")), run(table.where("id < 3")), run(table), run(table)] == [
        None, 2, 2, 5, 5]
    sent = [json.loads(r[0])["id"] for r in topics.read_batch(spark, topic).select(F.col("value").cast("string")).collect()]
    assert sorted(sent) == list(range(6))


def test_validated_write(spark):
    df = spark.createDataFrame([(1, "Tom", 29, "t"), (2, "", 35, "t")], schemas.PERSON_EVENT)
    records, bad = people.publish_people(df)
    got = records.collect()
    assert [bytes(r["key"]) for r in got] == [b"Tom"]
    assert json.loads(bytes(got[0]["value"])) == {"event_id": 1, "name": "Tom", "age": 29, "ts_utc": "t"}
    assert rows(bad, "event_id", "error") == [(2, "'name' is too short")]


def write_csv(path, lines):
    path.write_text("\n".join(lines) + "\n")


def test_tabular_ingest(spark, tmp_path):
    head = ",".join(tabular.FIELDS) + ",comment"
    line = "e{},c1,u,m,BOOKS,12.5,CAD,CA,CA,POS,t,hi"
    write_csv(tmp_path / "a.csv", [head, line.format(1), ",,,,,,,,,,,", line.format(2).replace("BOOKS", ""), line.format(3)])
    write_csv(tmp_path / "b.csv", [head, line.format(9)])
    table = tabular.read_payment_rows(spark, str(tmp_path))
    kept = tabular.keep_complete(table)
    assert rows(kept.select("event_id", "amount", "row", F.substring_index("source", "/", -1))) == [
        ("e1", 12.5, 2, "a.csv"), ("e3", 12.5, 5, "a.csv"), ("e9", 12.5, 2, "b.csv")]
    assert rows(tabular.skipped_rows(table), "row", "missing") == [(4, ["merchant_category"])]
    records, bad = payment_screening.ingest(spark, str(tmp_path))
    assert bad.count() == 0
    got = {json.loads(bytes(r["value"]))["event_id"]: r for r in records.collect()}
    assert sorted(got) == ["e1", "e3", "e9"] and bytes(got["e3"]["key"]) == b"c1"
    headers = {h["key"]: bytes(h["value"]) for h in got["e3"]["headers"]}
    assert headers["excel_row"] == b"5" and headers["excel_sheet"] == b"payments"
    assert headers["source"].endswith(b"a.csv")


def test_row_numbers_of_split_files(spark, tmp_path):
    (tmp_path / "x.txt").write_text("\n".join(f"line {i}" for i in range(1, 2001)) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        lines = tabular.numbered_lines(spark, str(tmp_path))
        assert lines.select("source").rdd.getNumPartitions() > 1
        assert lines.where(F.concat(F.lit("line "), "row") != F.col("value")).count() == 0
        assert lines.count() == 2000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_wrong_header_is_an_error(spark, tmp_path):
    write_csv(tmp_path / "a.csv", ["event_id,amount", "1,2"])
    with pytest.raises(ValueError, match="does not start with"):
        tabular.read_payment_rows(spark, str(tmp_path))


def test_header_lookup_and_map(spark):
    df = raw(spark, [with_()], headers=(("a", b"1"), ("b", None), ("a", b"2"), (None, b"3"), ("a", None)))
    got = df.select(topics.header(F.col("headers"), "a").alias("first"),
                    topics.header(F.col("headers"), "zz").alias("none"),
                    topics.header_map(F.col("headers")).alias("m")).first()
    assert (got["first"], got["none"]) == ("1", "?")
    assert {k: bytes(v) for k, v in got["m"].items()} == {"a": b"2"}
    assert raw(spark, [with_()], headers=None).select(topics.header_map(F.col("headers"))).first()[0] == {}


def test_transactions_from_json(spark):
    good = {"transaction_id": "t", "customer_id": "C1", "amount": 5, "event_time": 1704067200000}
    lines = [json.dumps(good), "  " + json.dumps({**good, "amount": "7.5", "hour": 3, "city": "Rome"}) + " ",
             "bad{", "5", "[1]", "null", json.dumps({k: v for k, v in good.items() if k != "amount"}),
             json.dumps({**good, "amount": None}), json.dumps({**good, "amount": "x"}),
             json.dumps({**good, "event_time": "x"}), json.dumps(good) + " extra"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = validate.parse_transactions(df, F.col("line"), F.timestamp_millis(F.lit(9)))
    assert rows(got.select("amount", "merchant", "city", "event_time", "hour", "complete",
                           F.unix_millis("event_ts"))) == sorted([
        (5.0, "", "", 1704067200000, 0, True, 1704067200000),
        (7.5, "", "Rome", 1704067200000, 3, True, 1704067200000),
        (5.0, "", "", None, 0, False, 9)], key=repr)


TEXTS = ["plain", "", "two\nlines", 'a "quoted" word', 'ends with "', '"', "three\n\nlines, with commas", '5" pipe', "x" * 300, 'tail "\n', '""\n""',
         '\n\n\n', ',",\n,"']


@pytest.mark.parametrize("split", [64, 1000, 1 << 27])
def test_records_with_line_breaks_in_quotes(spark, tmp_path, split):
    """Equal to a plain reader, with the number of each record's first line, however files are split over tasks."""
    dice, want = random.Random(9), []
    for name in ("a.csv", "b.csv", "c.csv"):
        out, line = io.StringIO(), 1
        writer = csv.writer(out, lineterminator="\n")
        for i in range(120):
            texts = TEXTS[:2] if name == "c.csv" else TEXTS
            fields = [str(i), dice.choice(texts), dice.choice(texts)]
            at = out.tell()
            writer.writerow(fields)
            want.append((name, line, fields))
            line += out.getvalue()[at:].count("\n")
        # Quotes inside a field that does not begin with one are plain text.
        out.write('200,5" pipe,6" pipe\n201,x,"last\n')
        want += [(name, line, ["200", '5" pipe', '6" pipe']), (name, line + 1, ["201", "x", "last\n"])]
        (tmp_path / name).write_text(out.getvalue())
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in before:
        spark.conf.set(k, str(split))
    try:
        got = tabular.numbered_records(spark, str(tmp_path)).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    # A quote that is never closed: the rest of the file, to its last line, is one record.
    made = sorted((r["source"].rsplit("/", 1)[1], r["row"], next(csv.reader([r["value"]], strict=False)) if not r["value"].startswith("201")
                   else ["201", "x", "last\n"]) for r in got)
    assert made == sorted(want)


@pytest.mark.parametrize("value", [
    "a,b", '"', 'a,"b', 'a,"b"', 'a,"b""', 'b",c', 'b","c', '5" x,"y', '5" x', '""', "", '"a"b"c,"d', ',,"', '"",""', '"""', 'x""",","'])
def test_line_maps(spark, value):
    row = spark.createDataFrame([(value,)], "value string").select(*tabular.line_map(F.col("value"))).first()
    # A plain machine: the state after each character.
    def run(inside):
        at, begins = 0, not inside
        while at < len(value):
            c = value[at]
            if inside:
                if c == '"' and value[at + 1:at + 2] == '"':
                    at += 1
                elif c == '"':
                    inside = False
            elif c == ",":
                begins = True
                at += 1
                continue
            elif c == '"' and begins:
                inside = True
            begins = False
            at += 1
        return inside
    assert tuple(row) == (run(False), run(True))


def test_payments_with_line_breaks(spark, tmp_path):
    head = ",".join(tabular.FIELDS) + ",comment"
    good = ["e1", "c", "u", "m", 'toys "and\nmore', "5.5", "USD", "DE", "DE", "POS", "t"]
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows([[*good, "x"], ["e2", *good[1:], "y\nz"], ["e3", *good[1:4], "", *good[5:], ""]])
    (tmp_path / "p.csv").write_text(head + "\n" + out.getvalue())
    table = tabular.read_payment_rows(spark, str(tmp_path))
    assert rows(tabular.keep_complete(table), "event_id", "merchant_category", "amount", "row") == [
        ("e1", 'toys "and\nmore', 5.5, 2), ("e2", 'toys "and\nmore', 5.5, 4)]
    assert rows(tabular.skipped_rows(table), "row", "missing") == [(7, ["merchant_category"])]


NESTED = """{"title": "order", "type": "object", "additionalProperties": false, "required": ["id", "ship"], "properties": {
  "id": {"type": "integer", "minimum": 1}, "gift": {"type": "boolean"}, "note": {"type": "string", "minLength": 2},
  "ship": {"type": "object", "additionalProperties": false, "required": ["city"], "properties": {
    "city": {"type": "string", "enum": ["Rome", "Oslo"]}, "floor": {"type": "integer", "minimum": 0},
    "geo": {"type": "object", "required": ["lat"], "properties": {"lat": {"type": "number", "minimum": -90}}}}}}}"""

DOCUMENTS = [
    ('{"id":1,"ship":{"city":"Rome"}}', None),
    ('{"ship":{"floor":2.0,"city":"Oslo","geo":{"lat":5,"more":[1]}},"gift":true,"id":7,"note":"ok"}', None),
    ('{"id":1}', "'ship' is a required property"),
    ('{"id":1,"ship":{}}', "'ship.city' is a required property"),
    ('{"id":1,"ship":[]}', "'ship' is not of type object"),
    ('{"id":1,"ship":{"city":"Bern"}}', "'ship.city' is not one of ['Rome', 'Oslo']"),
    ('{"id":1,"ship":{"city":"Rome","floor":-1}}', "'ship.floor' is less than the minimum of 0"),
    ('{"id":1,"ship":{"city":"Rome","floor":1.5}}', "'ship.floor' is not of type integer"),
    ('{"id":1,"ship":{"city":"Rome","floor":"1"}}', "'ship.floor' is not of type integer"),
    ('{"id":1,"ship":{"city":"Rome","floor":null}}', "'ship.floor' is not of type integer"),
    ('{"id":1,"ship":{"city":"Rome","floor":1e30}}', "'ship.floor' does not fit 64 bits"),
    ('{"id":1,"ship":{"city":"Rome","door":1}}', "additional properties are not allowed: ship.door"),
    ('{"id":1,"ship":{"city":"Rome"},"b":1,"a":2}', "additional properties are not allowed: a, b"),
    ('{"id":1,"ship":{"city":"Rome","geo":{}}}', "'ship.geo.lat' is a required property"),
    ('{"id":1,"ship":{"city":"Rome","geo":{"lat":-91}}}', "'ship.geo.lat' is less than the minimum of -90"),
    ('{"id":1,"ship":{"city":"Rome","geo":{"lat":"x"}}}', "'ship.geo.lat' is not of type number"),
    ('{"id":1,"gift":"no","ship":{"city":"Rome"}}', "'gift' is not of type boolean"),
    ('{"id":1,"note":"x","ship":{"city":"Rome"}}', "'note' is too short"),
    ('{"id":0,"ship":{"city":"Rome"}}', "'id' is less than the minimum of 1"),
    ('{"id":1,"ship.city":1,"ship":{"city":"Rome"}}', "additional properties are not allowed: ship.city"),
    ("[1]", "not of type object"), ("{", "not a JSON document"), ("", "not a JSON document"),
]


@pytest.mark.parametrize("open_", [False, True])
def test_rules_from_schema_text(spark, open_):
    """Nested and optional fields; with other keys allowed, only the complaints about them go."""
    text = NESTED.replace('"additionalProperties": false, ', "") if open_ else NESTED
    rules = schemas.rules_from(text)
    df = spark.createDataFrame(DOCUMENTS, "text string, want string")
    got = {r["text"]: r["error"] for r in validate.check(df, F.col("text"), rules).collect()}
    want = {t: None if open_ and w and w.startswith("additional") else w for t, w in DOCUMENTS}
    assert got == want
    valid = validate.valid_only(df, F.col("text"), rules)
    assert valid.schema == rules.schema and valid.count() == sum(w is None for w in want.values())
    event = validate.check(df.where(F.col("text").contains("more")), F.col("text"), rules).first()["event"].asDict(recursive=True)
    assert event == {"id": 7, "gift": True, "note": "ok", "ship": {"city": "Oslo", "floor": 2, "geo": {"lat": 5.0}}}


def test_the_published_schemas(spark):
    assert schemas.PAYMENT_RULES.schema == schemas.PAYMENT and schemas.PERSON_RULES.schema == schemas.PERSON_EVENT
    assert [f.name for f in schemas.PAYMENT_RULES.fields] == schemas.PAYMENT.fieldNames() and schemas.PAYMENT_RULES.closed


@pytest.mark.parametrize("change, complaint", [
    (('"minimum": 1', '"multipleOf": 1'), r"\$\.id: keyword 'multipleOf'"), (('"minLength": 2', '"pattern": "x"'), r"\$\.note: keyword 'pattern'"),
    (('"boolean"', '"array"'), r"\$\.gift: type 'array'"), (('["lat"]', '["lon"]'), r"\$\.ship\.geo: required property 'lon'"),
    (('"enum": ["Rome", "Oslo"]', '"enum": ["Rome", 1]'), "'enum' is understood for strings"), (('"title"', '"oneOf"'), "keyword 'oneOf'"),
    (('"additionalProperties": false, "required": ["id"', '"additionalProperties": {}, "required": ["id"'), "true or false only")])
def test_what_is_not_understood_is_refused(change, complaint):
    with pytest.raises(ValueError, match=complaint):
        schemas.rules_from(NESTED.replace(*change, 1))
