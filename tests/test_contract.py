import json
import math

import pytest
from helpers import T0, event, records

from sessionloom.functions.contract import (
    EVENT_TYPES,
    FIELDS,
    check_contract,
    event_schema,
    violation_rows,
    violation_text,
)
from sessionloom.operators.bronze import decode_records
from sessionloom.operators.silver import clean
from sessionloom.streaming.publish import accepted, counted, publish_checked, rejected, split_counts

VALID = "['add_to_cart', 'page_view', 'purchase', 'remove_from_cart', 'search']"


def without(name):
    full = event()
    del full[name]
    return full


def wrong(name, kind):
    allowed = "['int', 'float']" if name in ("price", "timestamp") else "['str']"
    return f"field '{name}' has type {kind}, expected one of {allowed}"


def invalid(shown):
    return f"field 'event_type' has invalid value {shown}, expected one of {VALID}"


def raw(**literals):
    """JSON text of an event with some values given as literal JSON."""
    text = json.dumps({**event(), **{k: f"@{k}" for k in literals}})
    for name, literal in literals.items():
        text = text.replace(f'"@{name}"', literal)
    return text


# (JSON, violations, fields as parsed into bronze or None for all null, kept by silver)
CASES = {
    "full": (raw(), "", {"price": 9.5}, True),
    "integer price": (raw(price="5"), "", {"price": 5.0}, True),
    "bool price": (raw(price="true"), wrong("price", "bool"), {"price": None}, False),
    "text price": (raw(price='"12.5"'), wrong("price", "str"), {"price": None}, False),
    "NaN text": (raw(price='"NaN"'), wrong("price", "str"), {"price": math.nan}, False),
    "huge price": (raw(price="1" + "0" * 25), "", {"price": 1e25}, True),
    "negative price": (raw(price="-3"), "", {"price": -3.0}, True),
    "null price": (raw(price="null"), wrong("price", "NoneType"), {"price": None}, False),
    "int id": (raw(event_id="123"), wrong("event_id", "int"), {"event_id": "123"}, True),
    "long int id": (
        raw(event_id="12345678901234567890"),
        wrong("event_id", "int"),
        {"event_id": "12345678901234567890"},
        True,
    ),
    "float id": (raw(event_id="5.5"), wrong("event_id", "float"), {"event_id": "5.5"}, True),
    "bool id": (raw(event_id="true"), wrong("event_id", "bool"), {"event_id": "true"}, True),
    "object id": (raw(event_id='{"a":1}'), wrong("event_id", "dict"), {"event_id": '{"a":1}'}, True),
    "list id": (raw(event_id="[1]"), wrong("event_id", "list"), {"event_id": "[1]"}, True),
    "no user": (without("user_id"), "missing required field 'user_id'", {"user_id": None}, False),
    "extra keys": (
        event(zz=1, aa="x"),
        "unexpected extra field(s): ['aa', 'zz']",
        {"event_id": "e1"},
        True,
    ),
    "quote in key": (event(**{"a'b": 1}), 'unexpected extra field(s): ["a\'b"]', {}, True),
    "unknown type": (event(event_type="zzz"), invalid("'zzz'"), {"event_type": "zzz"}, False),
    "upper case": (event(event_type="PAGE_VIEW"), invalid("'PAGE_VIEW'"), {}, False),
    "null type": (
        raw(event_type="null"),
        wrong("event_type", "NoneType") + "; " + invalid("None"),
        {"event_type": None},
        False,
    ),
    "bool type": (
        raw(event_type="true"),
        wrong("event_type", "bool") + "; " + invalid("True"),
        {"event_type": "true"},
        False,
    ),
    "int type": (
        raw(event_type="5"),
        wrong("event_type", "int") + "; " + invalid("5"),
        {"event_type": "5"},
        False,
    ),
    "text time": (
        raw(timestamp='"2024-01-01"'),
        wrong("timestamp", "str"),
        {"timestamp": None},
        False,
    ),
    "all at once": (
        {"event_id": 1, "event_type": "zzz", "zz": 1, "price": None, "timestamp": 1},
        "; ".join(
            [
                wrong("event_id", "int"),
                "missing required field 'user_id'",
                "missing required field 'session_id'",
                "missing required field 'product_id'",
                wrong("price", "NoneType"),
                invalid("'zzz'"),
                "unexpected extra field(s): ['zz']",
            ]
        ),
        {"event_id": "1", "timestamp": 1.0},
        False,
    ),
    "truncated": (raw()[:20], "unparseable JSON", None, False),
    "word": ("hello", "unparseable JSON", None, False),
    "number": ("5", "not a JSON object", None, False),
    "null": ("null", "not a JSON object", None, False),
    "list": (f"[{raw()}]", "not a JSON object", None, False),
    "empty": ("", "unparseable JSON", None, False),
    "no value": (None, "unparseable JSON", None, False),
}


@pytest.fixture(scope="module")
def decoded(spark):
    df = records(spark, *[case[0] for case in CASES.values()])
    bronze = decode_records(df)
    kept = {r["kafka_offset"] for r in clean(bronze).collect()}
    checked = check_contract(bronze).withColumn("text", violation_text())
    by_offset = {r["kafka_offset"]: r for r in checked.collect()}
    return {
        name: (by_offset[i], i in kept) for i, name in enumerate(CASES)
    }


@pytest.mark.parametrize("name", CASES)
def test_json_case(decoded, name):
    value, text, fields, kept = CASES[name]
    row, was_kept = decoded[name]
    assert row["text"] == text
    assert was_kept == kept
    expected = dict.fromkeys(FIELDS) if fields is None else fields
    for field, want in expected.items():
        if isinstance(want, float) and math.isnan(want):
            assert math.isnan(row[field])
        else:
            assert row[field] == want, field
    plain = value if value is None or isinstance(value, str) else json.dumps(value)
    assert row["raw_value"] == plain


def test_lenient_literals(spark):
    """Number words and repeated keys: the parse takes them, the stricter check does not. Text
    after the event is overlooked by both."""
    df = records(
        spark,
        raw(price="NaN"),
        raw(price="Infinity"),
        raw()[:-1] + ', "event_id": "e2"}',
        raw() + " trailing",
    )
    bronze = decode_records(df)
    parsed = bronze.orderBy("kafka_offset").collect()
    assert math.isnan(parsed[0]["price"])
    assert parsed[1]["price"] == math.inf
    assert parsed[2]["event_id"] == "e2"
    assert parsed[3]["event_id"] == "e1"
    kept = {r["kafka_offset"] for r in clean(bronze).collect()}
    assert kept == {1, 2, 3}
    checked = check_contract(bronze).orderBy("kafka_offset").select(violation_text())
    assert [r[0] for r in checked.collect()] == ["unparseable JSON"] * 3 + [""]


def test_schema_forms():
    strict, relaxed = event_schema(), event_schema(strict=False)
    assert strict.names == relaxed.names == FIELDS
    assert not any(f.nullable for f in strict.fields)
    assert all(f.nullable for f in relaxed.fields)
    assert len(EVENT_TYPES) == 5


def test_split_and_counters(spark, base):
    df = decode_records(records(spark, event(), without("price"), event(event_type="no"), "x"))
    checked = check_contract(df.select("raw_value"))
    assert [tuple(r) for r in split_counts(checked).collect()] == [(1, 3)]
    assert accepted(checked).count() == 1
    refused = {(r["session_id"], r["event_type"]) for r in rejected(checked).collect()}
    assert refused == {("s1", "page_view"), ("s1", "no"), (None, None)}
    assert violation_rows(checked).count() == 3

    publish_checked(df.select("raw_value"), f"{base}/out")
    schema = "key binary, value binary, reason string, accepted boolean"
    out = spark.read.schema(schema).parquet(f"{base}/out")
    assert out.where("accepted").count() == 1
    assert {bytes(r["key"]) for r in out.where("accepted").collect()} == {b"s1"}
    assert out.where("NOT accepted AND reason <> ''").count() == 3


def test_stream_counters(spark, base):
    from helpers import stream_records

    records(spark, event(), "x", event(price=True)).coalesce(1).write.parquet(f"{base}/in")
    decoded = decode_records(stream_records(spark, f"{base}/in")).select("raw_value")
    query = (
        counted(check_contract(decoded))
        .writeStream.format("noop")
        .option("checkpointLocation", f"{base}/c")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    metrics = [p["observedMetrics"]["contract"] for p in query.recentProgress if p["numInputRows"]]
    assert [(m["sent"], m["rejected"]) for m in metrics] == [(1, 2)]


def test_epoch_edges(spark):
    """A time that is no instant becomes null and the row stays."""
    times = ["Infinity", "1.7e18", str(T0 + 0.123456), "-1.5"]
    df = clean(decode_records(records(spark, *[raw(timestamp=t) for t in times])))
    got = [r[0] for r in df.orderBy("kafka_offset").selectExpr("unix_micros(event_time)").collect()]
    assert got == [None, None, T0 * 1_000_000 + 123456, -1_500_000]
