"""JSON records to typed rows and back, event-time extraction, routing by topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

_CORRUPT = "__corrupt"
_DEFAULTS = {"bigint": 0, "double": 0.0, "boolean": False}


def _cast(raw: Column, field: StructField) -> Column:
    kind = field.dataType.simpleString()
    if isinstance(field.dataType, LongType):
        # "12" and 12.7 are both accepted for a long field
        return F.coalesce(raw.try_cast("bigint"), raw.try_cast("double").try_cast("bigint"))
    return raw if isinstance(field.dataType, StringType) else raw.try_cast(kind)


def decode(df: DataFrame, schema: StructType, on_error: str = "fail", value: str = "value",
           fallback: Column | str | None = None) -> DataFrame:
    """Parse a JSON text column into the fields of ``schema`` plus the event time ``ts``.

    Unknown fields are ignored; missing numbers and booleans become 0 and false, missing strings
    null.  ``ts`` comes from ``ts_ms`` and, where that is missing, from ``fallback`` (a record
    time column; processing time by default).

    ``on_error``: ``fail`` raises on a malformed record, ``skip`` drops it, ``quarantine`` keeps
    it with its text in ``malformed`` (null on good rows) so that one pass serves both outputs.

    Every record is parsed once.  Filters on its fields, written or inferred by Spark from joins,
    would be moved below a plain projection and repeat the parsing for every field they name, so
    the record comes out of an ``explode``, which they do not cross.
    """
    if on_error not in ("fail", "skip", "quarantine"):
        raise ValueError(f"unknown on_error: {on_error}")
    # numbers may arrive as strings: read every field as text and cast
    as_text = StructType([StructField(f.name, StringType()) for f in schema] + [StructField(_CORRUPT, StringType())])
    record = F.from_json(value, as_text, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})

    def is_bad(r: Column) -> Column:
        bad = r.isNull() | r[_CORRUPT].isNotNull()
        for f in schema:
            bad = bad | (r[f.name].isNotNull() & _cast(r[f.name], f).isNull())
        return bad

    records = F.array(record)
    if on_error == "skip":
        records = F.filter(records, lambda r: ~is_bad(r))
    parsed = df.select("*", F.explode(records).alias("__r"))
    bad = is_bad(F.col("__r"))
    refuse = F.raise_error(F.concat(F.lit("malformed record: "), F.coalesce(F.col(value), F.lit("null"))))

    def checked(column: Column, kind: str) -> Column:
        return F.when(bad, refuse.cast(kind)).otherwise(column) if on_error == "fail" else column

    columns = []
    for f in schema:
        kind = f.dataType.simpleString()
        column = _cast(F.col(f"__r.{f.name}"), f)
        column = column if kind not in _DEFAULTS else F.coalesce(column, F.lit(_DEFAULTS[kind]))
        columns.append(checked(column, kind).alias(f.name))
    event_ms = _cast(F.col("__r.ts_ms"), schema["ts_ms"])
    received = F.current_timestamp() if fallback is None else fallback
    columns.append(checked(F.coalesce(F.timestamp_millis(event_ms), received), "timestamp").alias("ts"))
    if on_error == "quarantine":
        columns.append(F.when(bad, F.coalesce(F.col(value), F.lit(""))).alias("malformed"))
    return parsed.select(*columns)


def encode(df: DataFrame, *columns: str) -> DataFrame:
    """One JSON object per row in ``value``, null fields included."""
    return df.select(F.to_json(F.struct(*(columns or df.columns)), {"ignoreNullFields": "false"}).alias("value"))


def _typed(messages: DataFrame, topics: dict[str, str]) -> DataFrame:
    pairs = [F.lit(part) for item in topics.items() for part in item]
    return (messages.withColumn("type", F.create_map(*pairs)[F.col("topic")])
            .filter(F.col("type").isNotNull()))


def relay(messages: DataFrame, topics: dict[str, str]) -> DataFrame:
    """``(topic, value)`` messages of any layout to ``(type, payload)``, payload still JSON text.

    Messages of unknown topics and messages that are not JSON are dropped.
    """
    known = _typed(messages, topics).filter(F.try_parse_json("value").isNotNull())
    return known.select("type", F.col("value").alias("payload"))


def route(messages: DataFrame, topics: dict[str, str], schema: StructType) -> DataFrame:
    """The same for topics that share one layout, as typed rows with a ``type`` column."""
    with_corrupt = StructType(schema.fields + [StructField(_CORRUPT, StringType())])
    record = F.from_json("value", with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    good = F.filter(F.array(record), lambda r: r.isNotNull() & r[_CORRUPT].isNull())
    return _typed(messages, topics).select("type", F.explode(good).alias("__r")).select(
        "type", *[F.col(f"__r.{f.name}").alias(f.name) for f in schema])
