"""P1-P5 broker parse, D18 malformed input, K1 round trip."""

import datetime as dt

from pyspark.sql import functions as F

from detour import schemas as S
from detour.operators import parse as P
from detour.sources.broker import to_broker_records


def _records(spark, texts):
    ts = dt.datetime(2024, 1, 1, 12, 0, 0)
    df = spark.createDataFrame([(t, ts) for t in texts], "v string, timestamp timestamp")
    return df.select(F.col("v").cast("binary").alias("value"), "timestamp")


GOOD = ('{"event_type":"tube_line_status","line_id":"central","line_name":"Central","severity_code":6,'
        '"severity_desc":"Severe Delays","is_disrupted":true,"disruption_detail":null,'
        '"ingested_at_utc":"2024-01-01T12:00:00+00:00"}')


def test_parse_flattens_and_keeps_broker_time(spark):
    out = P.parse_records(_records(spark, [GOOD]))
    assert out.columns == [f.name for f in S.STATUS_EVENT.fields] + ["event_hub_timestamp"]
    r = out.first()
    assert (r.line_id, r.severity_code, r.is_disrupted) == ("central", 6, True)
    assert r.event_hub_timestamp == dt.datetime(2024, 1, 1, 12, 0, 0)


def test_malformed_records_are_null_and_filtered(spark):
    parsed = P.parse_records(_records(spark, ["not json", None, "[1,2]", GOOD]))
    assert parsed.filter(P.rejected(parsed)).count() == 3
    assert P.disrupted(parsed).count() == 1


def test_null_flag_filtered(spark):
    txt = GOOD.replace('"is_disrupted":true', '"is_disrupted":null')
    assert P.disrupted(P.parse_records(_records(spark, [txt]))).count() == 0


def test_wrong_typed_field_nulls_only_itself(spark):
    txt = GOOD.replace('"severity_code":6', '"severity_code":"7"')
    out = P.disrupted(P.parse_records(_records(spark, [txt]))).collect()
    assert len(out) == 1 and out[0].severity_code is None and out[0].line_id == "central"


def test_processed_time_is_added(spark):
    out = P.disrupted(P.parse_records(_records(spark, [GOOD])))
    assert "processed_at_utc" in out.columns and out.first().processed_at_utc is not None


def test_publish_then_parse_round_trip(spark):
    ev = spark.createDataFrame(
        [("tube_line_status", "central", "Central", 6, "Severe", True, None, "t0"),
         ("tube_line_status", "victoria", "Victoria", 10, "Good", False, "x \"quoted\"", "t0")],
        S.STATUS_EVENT)
    rec = to_broker_records(ev, [f.name for f in S.STATUS_EVENT.fields])
    assert rec.schema["value"].dataType.typeName() == "binary"
    # nulls are written as null, like a JSON encoder does
    assert '"disruption_detail":null' in rec.first().value.decode()
    back = P.parse_records(rec).drop("event_hub_timestamp")
    assert sorted(back.collect()) == sorted(ev.collect())


def test_rejected_checks_every_field(spark):
    txt = GOOD.replace('"event_type":"tube_line_status",', '')   # first field missing, others present
    parsed = P.parse_records(_records(spark, [txt, "{}"]))
    assert [r.line_id for r in parsed.filter(~P.rejected(parsed)).collect()] == ["central"]
    assert parsed.filter(P.rejected(parsed)).count() == 1


def test_kafka_options_source_and_sink():
    from detour.sources.broker import kafka_options
    src = kafka_options("h:9093", "t", sasl_jaas="jaas")
    assert src["subscribe"] == "t" and src["startingOffsets"] == "latest" and src["failOnDataLoss"] == "false"
    assert src["kafka.security.protocol"] == "SASL_SSL" and src["kafka.sasl.mechanism"] == "PLAIN"
    snk = kafka_options("h:9093", "t", for_sink=True)
    assert snk["topic"] == "t" and "subscribe" not in snk and "startingOffsets" not in snk
