"""Update sources and checks: the golden cases."""

import gzip
import math

import pytest
from pyspark.sql import functions as F

import tallymark as tm
from tallymark.operators.validate import status_code


def text_rows(spark, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "seq bigint, type string, name string, raw_value string")


TEXT_ROWS = [
    (("gauge", "Alloc", "123.45"), (123.45, None, None)),
    (("counter", "PollCount", "7"), (None, 7, None)),
    (("gauge", "", "1"), (1.0, None, "name_empty")),
    (("gauge", None, "1"), (1.0, None, "name_empty")),
    (("histogram", "Alloc", "1"), (None, None, "unsupported_type")),
    (("Gauge", "Alloc", "1"), (None, None, "unsupported_type")),
    ((None, "Alloc", "1"), (None, None, "unsupported_type")),
    (("gauge", "Alloc", "abc"), (None, None, "invalid_value")),
    (("counter", "PollCount", "abc"), (None, None, "invalid_value")),
    (("counter", "PollCount", "1.5"), (None, None, "invalid_value")),
    (("histogram", "", "abc"), (None, None, "name_empty")),
]


def test_text_checks(spark):
    rows = tm.check_text(text_rows(spark, *[row for row, _ in TEXT_ROWS])).orderBy("seq").collect()
    assert [(r.value, r.delta, r.error) for r in rows] == [want for _, want in TEXT_ROWS]


def test_text_nan_is_accepted(spark):
    got = tm.check_text(text_rows(spark, ("gauge", "x", "NaN"))).first()
    assert math.isnan(got.value) and got.error is None


def test_length_limits_are_optional(spark):
    rows = text_rows(spark, ("gauge", "n" * 256, "1"), ("gauge", "é" * 255, "1"))
    assert [r.error for r in tm.check_text(rows).orderBy("seq").collect()] == [None, None]
    assert [r.error for r in tm.check_text(rows, max_lengths=True).orderBy("seq").collect()] == ["name_too_long", None]


def test_typed_checks(spark):
    rows = spark.createDataFrame(
        [
            (0, "gauge", "a", 1.0, 5), (1, "counter", "a", 1.0, 5), (2, "gauge", "a", None, 5),
            (3, "counter", "a", 1.0, None), (4, "x", "", 1.0, 1), (5, "gauge", "", 1.0, None), (6, "gauge", "", None, None),
        ],
        "seq int, type string, name string, value double, delta bigint",
    )
    got = [(r.value, r.delta, r.error) for r in tm.check_typed(rows).orderBy("seq").collect()]
    assert got == [
        (1.0, None, None), (None, 5, None), (None, None, "value_required"), (None, None, "delta_required"),
        (None, None, "unsupported_type"), (1.0, None, "name_empty"), (None, None, "value_required"),
    ]


def test_snapshot_checks(spark):
    rows = spark.createDataFrame(
        [
            (0, "a", "gauge", 1.0, None), (1, "a", "counter", None, 1), (2, "", "x", None, None), (3, "a", "x", 1.0, None),
            (4, "a", "gauge", None, None), (5, "a", "gauge", 1.0, 1), (6, "a", "counter", 1.0, 1), (7, "a", "counter", None, None),
        ],
        "n int, id string, type string, value double, delta bigint",
    )
    got = [r.error for r in tm.check_snapshot(rows).orderBy("n").collect()]
    assert got == [None, None, "id_empty", "unsupported_type"] + ["operand_mismatch"] * 4


def test_status_codes(spark):
    errors = [None, "name_empty", "not_found", "unsupported_type", "invalid_value", "malformed_json", "boom"]
    rows = spark.createDataFrame([(e,) for e in errors], "e string")
    assert [r[0] for r in rows.select(status_code(F.col("e"))).collect()] == [200, 404, 404, 400, 400, 400, 500]


PATHS = [
    ("/update/gauge/Alloc/123.45", ("gauge", "Alloc", "123.45", None)),
    ("/update/gauge/Alloc/123.45/", ("gauge", "Alloc", "123.45", None)),
    ("/update/gauge/Alloc/1?x=2", ("gauge", "Alloc", "1", None)),
    ("/update/gauge//1", ("gauge", "", "1", None)),
    ("/update/gauge/a%20b/1", ("gauge", "a b", "1", None)),
    ("/update/gauge/a+b/1", ("gauge", "a+b", "1", None)),
    ("/update/gauge/%D0%B9/1", ("gauge", "й", "1", None)),
    ("/update/gauge/a%2Fb/1", ("gauge", "a%2Fb", "1", None)),
    ("/update/gauge/Alloc", (None, None, None, "no_route")),
    ("/update/gauge/Alloc/", (None, None, None, "no_route")),
    ("/update/gauge/Alloc/1//", (None, None, None, "no_route")),
    ("/update/gauge/Alloc/1/2", (None, None, None, "no_route")),
    ("/value/gauge/Alloc/1", (None, None, None, "no_route")),
    ("/update/gauge/%zz/1", (None, None, None, "no_route")),
    (None, (None, None, None, "no_route")),
]


def numbered(spark, cases, name):
    return spark.createDataFrame([(i, case) for i, (case, _) in enumerate(cases)], f"n int, {name} string")


def test_request_paths(spark):
    rows = tm.updates_from_uris(numbered(spark, PATHS, "uri")).orderBy("n").collect()
    assert [(r.type, r.name, r.raw_value, r.route_error) for r in rows] == [want for _, want in PATHS]


DOCUMENTS = [
    ('{"id":"Alloc","type":"gauge","value":123.45}', ("gauge", "Alloc", 123.45, None, None)),
    ('{"ID":"P","Type":"counter","DELTA":7}', ("counter", "P", None, 7, None)),
    ('{"id":"P","type":"counter","delta":7} {"id":"x"}', ("counter", "P", None, 7, None)),
    ('{"id":"P","type":"counter","delta":7,"host":{"a":[1]}}', ("counter", "P", None, 7, None)),
    ('{"id":"P","type":"counter","delta":3,"delta":7}', ("counter", "P", None, 7, None)),
    ('{"id":"P","type":"counter","delta":7,"value":1.5}', ("counter", "P", None, 7, None)),
    ('{"id":"q\\"}","type":"gauge","value":1}', ("gauge", 'q"}', 1.0, None, None)),
    ('{"id":"A","type":"gauge","value":1e5}', ("gauge", "A", 1e5, None, None)),
    ('{"id":"A","type":"gauge"}', ("gauge", "A", None, None, "value_required")),
    ('{"id":"A","type":"gauge","value":null}', ("gauge", "A", None, None, "value_required")),
    ('{"id":"A","type":"counter"}', ("counter", "A", None, None, "delta_required")),
    ('{"id":"A","type":"unknown","value":1}', ("unknown", "A", None, None, "unsupported_type")),
    ('{"type":"gauge","value":1}', ("gauge", "", 1.0, None, "name_empty")),
    ("{}", ("", "", None, None, "unsupported_type")),
    ("null", ("", "", None, None, "unsupported_type")),
    ('{"id":"A","type":"gauge","value":invalid}', (None, None, None, None, "malformed_json")),
    ('{"id":"A","type":"gauge","value":"1"}', (None, None, None, None, "malformed_json")),
    ('{"id":"A","type":"gauge","value":1e400}', (None, None, None, None, "malformed_json")),
    ('{"id":"A","type":"gauge","value":NaN}', (None, None, None, None, "malformed_json")),
    ('{"id":"A","type":"counter","delta":1.5}', (None, None, None, None, "malformed_json")),
    ('{"id":"A","type":"counter","delta":1e3}', (None, None, None, None, "malformed_json")),
    ('{"id":"A","type":"counter","delta":9223372036854775808}', (None, None, None, None, "malformed_json")),
    ('{"id":"A","type":"counter","delta":9223372036854775807}', ("counter", "A", None, 2**63 - 1, None)),
    ('{"id":5,"type":"counter","delta":1}', (None, None, None, None, "malformed_json")),
    ("{'id':'A','type':'gauge','value':1}", (None, None, None, None, "malformed_json")),
    ('{"id":"A","type":"gauge","value":1', (None, None, None, None, "malformed_json")),
    ('[{"id":"A","type":"gauge","value":1}]', (None, None, None, None, "malformed_json")),
    ("", (None, None, None, None, "malformed_json")),
    (None, (None, None, None, None, "malformed_json")),
]


def test_single_documents(spark):
    rows = tm.decode_updates(numbered(spark, DOCUMENTS, "doc")).orderBy("n").collect()
    assert [(r.type, r.name, r.value, r.delta, r.error) for r in rows] == [want for _, want in DOCUMENTS]


GAUGE = '{"id":"Alloc","type":"gauge","value":123.45}'
COUNTER = '{"id":"PollCount","type":"counter","delta":7}'


BATCHES = [
    (f"[{GAUGE},{COUNTER}]", [(0, "Alloc", None), (1, "PollCount", None)]),
    (f" [{GAUGE}] trailing", [(0, "Alloc", None)]),
    ("[]", []),
    ("null", []),
    ('[{"id":"Alloc","type":"gauge","value":invalid}]', [(None, None, "malformed_json")]),
    (GAUGE, [(None, None, "malformed_json")]),
    (f"[{GAUGE}", [(None, None, "malformed_json")]),
    ("[1]", [(None, None, "malformed_json")]),
    (f'[{GAUGE},{{"id":"x","type":"counter","delta":"7"}}]', [(None, None, "malformed_json")]),
    ('[{"id":"Alloc","type":"gauge"}]', [(0, "Alloc", "value_required")]),
    ('[{"id":"PollCount","type":"counter"}]', [(0, "PollCount", "delta_required")]),
    ('[{"id":"Alloc","type":"unknown","value":123.45}]', [(0, "Alloc", "unsupported_type")]),
    (f"[{GAUGE},null]", [(0, "Alloc", "unsupported_type"), (1, "", "unsupported_type")]),
    # A wrong operand decides before an empty name, even one further ahead.
    ('[{"id":"","type":"gauge","value":1},{"id":"x","type":"counter"}]', [(0, "", "delta_required"), (1, "x", "delta_required")]),
    (f'[{GAUGE},{{"id":"","type":"gauge","value":1}}]', [(0, "Alloc", "name_empty"), (1, "", "name_empty")]),
]


def test_batch_documents(spark):
    rows = tm.decode_batches(numbered(spark, BATCHES, "doc")).orderBy("n", "pos").collect()
    got = [[(r.pos, r.name, r.error) for r in rows if r.n == n] for n in range(len(BATCHES))]
    assert got == [want for _, want in BATCHES]


LOOKUPS = [
    ('{"id":"Alloc","type":"gauge"}', ("gauge", "Alloc", None)),
    ('{"ID":"Alloc","type":"gauge","value":3}', ("gauge", "Alloc", None)),
    ('{"id":"a}{b","type":"gauge"} ', ("gauge", "a}{b", None)),
    ('{"id":"","type":"gauge"}', ("gauge", "", None)),
    ("null", ("", "", None)),
    ('{"id":"Alloc","type":"gauge"', (None, None, "malformed_json")),
    ('{"id":"Alloc","type":"gauge","host":1}', (None, None, "malformed_json")),
    ('{"id":"Alloc","type":"gauge"}{}', (None, None, "malformed_json")),
    ('{"id":"Alloc","type":"gauge"} x', (None, None, "malformed_json")),
    ('{"id":7,"type":"gauge"}', (None, None, "malformed_json")),
]


def test_lookup_documents(spark):
    rows = tm.decode_lookups(numbered(spark, LOOKUPS, "doc")).orderBy("n").collect()
    assert [(r.type, r.name, r.error) for r in rows] == [want for _, want in LOOKUPS]


def test_rejected_batches_go_whole(spark):
    rows = spark.createDataFrame(
        [(1, 1, "gauge", "a", "1"), (2, 1, "gauge", "a", "x"), (3, 2, "gauge", "b", "1"), (4, 2, "counter", "b", "2")],
        "seq bigint, batch_id bigint, type string, name string, raw_value string",
    )
    checked = tm.check_text(rows)
    assert {r.seq for r in tm.drop_rejected_batches(checked).collect()} == {3, 4}
    assert {(r.batch_id, r.error) for r in tm.batch_verdicts(checked).collect()} == {(1, "invalid_value"), (2, None)}
    assert {(r.batch_id, r.n_items, r.n_gauges, r.n_counters) for r in tm.batch_profile(checked).collect()} == {(1, 2, 2, 0), (2, 2, 1, 1)}


def test_gzip_documents(spark, tmp_path):
    good, bad = tmp_path / "good.gz", tmp_path / "bad.gz"
    good.write_bytes(gzip.compress(f"[{GAUGE}]\n[{COUNTER}]\n".encode()))
    bad.write_bytes(b"this is not gzip")
    docs = tm.read_documents(spark, str(good))
    assert {r.name for r in tm.decode_batches(docs).collect()} == {"Alloc", "PollCount"}
    with pytest.raises(Exception):
        tm.read_documents(spark, str(bad)).collect()
