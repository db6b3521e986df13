"""Broker records -> typed status events (P1-P5, R1). Same code for batch and stream."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from detour.fixed import BROKER_TIME_COLUMN
from detour.schemas import STATUS_EVENT


def parse_records(records: DataFrame, schema=STATUS_EVENT, keep: list[str] | None = None) -> DataFrame:
    """P1 bytes -> text, P2 JSON -> struct by a fixed schema, P3 flatten and keep
    the broker time as ``event_hub_timestamp``. Malformed JSON yields all-null fields."""
    keep = keep or []
    return (records
            .select(*keep,
                    F.from_json(F.col("value").cast("string"), schema).alias("data"),
                    F.col("timestamp").alias(BROKER_TIME_COLUMN))
            .select(*keep, "data.*", BROKER_TIME_COLUMN))


def rejected(parsed: DataFrame, schema=STATUS_EVENT) -> Column:
    """A record whose every schema field came out null (bad JSON, null value,
    a JSON array ...). Such rows are dropped by the disruption filter; this predicate
    lets a caller count them into a quarantine output instead."""
    fields = schema.fields if isinstance(schema, StructType) else StructType.fromDDL(schema).fields
    present = [F.col(f.name).isNotNull() for f in fields]
    return ~reduce(lambda a, b: a | b, present, F.lit(False))


def disrupted(events: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """P4 keep disrupted (drops false and null), P5 stamp processing time."""
    stamp = F.current_timestamp() if processed_at is None else processed_at
    return events.filter(F.col("is_disrupted")).withColumn("processed_at_utc", stamp)


def quarantine(records: DataFrame, schema=STATUS_EVENT) -> DataFrame:
    """The raw records that parse to nothing, kept as text with their broker time."""
    parsed = parse_records(records.select("value", "timestamp",
                                          F.col("value").cast("string").alias("raw_value")),
                           schema, keep=["raw_value"])
    return parsed.filter(rejected(parsed, schema)).select("raw_value", BROKER_TIME_COLUMN)


def field_faults(records: DataFrame, schema=STATUS_EVENT, required: Sequence[str] = ()) -> DataFrame:
    """D18 by field: one row for each thing wrong with a record (raw_value, event_hub_timestamp, field, fault, given).

    ``wrong type``: the record has a value there that isn't of the field's type, and would pass as null. ``missing``: a field of
    ``required`` is absent or null. ``unknown field``: the schema doesn't have it. ``not an object``: the text isn't a JSON object
    (field '', one row a record). A record without faults gives no row. Fields of type string take any value, as the parser does.
    Each record is parsed twice, once by the schema and once as a map of texts; nothing is shuffled."""
    fields = (schema if isinstance(schema, StructType) else StructType.fromDDL(schema)).fields
    text = F.col("value").cast("string")
    read = records.select(text.alias("raw_value"), F.col("timestamp").alias(BROKER_TIME_COLUMN), F.from_json(text, StructType(fields)).alias("_data"),
                          F.from_json(text, "map<string,string>").alias("_raw"))

    def fault(field: Column, name: str, given: Column) -> Column:
        return F.struct(field.alias("field"), F.lit(name).alias("fault"), given.cast("string").alias("given"))

    none = F.lit(None).cast("struct<field:string,fault:string,given:string>")
    checks = []
    for f in fields:
        given = F.element_at("_raw", F.lit(f.name))
        check = F.when(given.isNotNull() & F.col("_data")[f.name].isNull(), fault(F.lit(f.name), "wrong type", given))
        if f.name in required:
            check = check.when(given.isNull(), fault(F.lit(f.name), "missing", F.lit(None)))
        checks.append(check.otherwise(none))
    known = F.array(*[F.lit(f.name) for f in fields])
    extra = F.transform(F.array_except(F.map_keys("_raw"), known), lambda k: fault(k, "unknown field", F.element_at("_raw", k)))
    faults = F.when(F.col("_raw").isNull(), F.array(fault(F.lit(""), "not an object", F.lit(None)))).otherwise(
        F.concat(F.filter(F.array(*checks), lambda x: x.isNotNull()), extra))
    return read.select("raw_value", BROKER_TIME_COLUMN, F.explode(faults).alias("_f")).select("raw_value", BROKER_TIME_COLUMN, "_f.*")
