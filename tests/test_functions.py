"""F3-F8 column functions against the Python behaviour they reproduce."""

import datetime as dt
import json


from detour.functions import columns as C
from detour.sources.vocabulary import TUBE_LINES


def test_iso_and_str_timestamps_match_python(spark):
    vals = [dt.datetime(2024, 1, 1, 0, 0, 7, 179575), dt.datetime(2024, 3, 1, 12, 30, 0, 0),
            dt.datetime(2024, 12, 31, 23, 59, 59, 1), None]
    df = spark.createDataFrame([(v,) for v in vals], "ts timestamp")
    got = df.select(C.iso_utc("ts").alias("a"), C.py_timestamp_str("ts").alias("b")).collect()
    for v, r in zip(vals, got):
        if v is None:
            assert r.a is None and r.b is None
        else:
            assert r.a == v.replace(tzinfo=dt.timezone.utc).isoformat()
            assert r.b == str(v)


def test_title_from_id_matches_python_for_line_ids(spark):
    df = spark.createDataFrame([(x,) for x in TUBE_LINES], "id string")
    got = [r.t for r in df.select(C.title_from_id("id").alias("t")).collect()]
    assert got == [x.replace("-", " ").title() for x in TUBE_LINES]


def test_json_payload_keeps_nulls_and_preview_cuts(spark):
    df = spark.createDataFrame([("a" * 300, None)], "s string, n int")
    r = df.select(C.json_payload("s", "n").alias("j")).first()
    assert json.loads(r.j) == {"s": "a" * 300, "n": None}
    p = df.select(C.preview(C.json_payload("s", "n"), 200).alias("p")).first().p
    assert len(p) == 200 and p.startswith('{"s":"aaa')


def test_gridlock_label(spark):
    df = spark.createDataFrame([(True,), (False,)], "g boolean")
    assert [r.l for r in df.select(C.gridlock_label("g").alias("l")).collect()] == \
        ["GRIDLOCK ALERT", "Alternatives available"]


def test_default_coalesce(spark):
    df = spark.createDataFrame([(None,), ("x",)], "s string")
    assert [r.v for r in df.select(C.with_default("s", "unknown").alias("v")).collect()] == ["unknown", "x"]


def test_title_differs_from_python_only_after_non_blank_separators(spark):
    """Initcap capitalises after blanks only; Python's title() after any non-letter."""
    df = spark.createDataFrame([("king's cross-x",)], "id string")
    got = df.select(C.title_from_id("id").alias("t")).first().t
    assert got == "King's Cross X"
    assert "king's cross-x".replace("-", " ").title() == "King'S Cross X"
