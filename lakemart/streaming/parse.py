"""Stream message parsing: binary ``value`` -> JSON -> typed columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import STREAM_EVENT

STREAM_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def tag_events(raw: DataFrame, schema=STREAM_EVENT, time_format: str | None = None) -> DataFrame:
    """Parse the ``value`` column (binary or string JSON) and tag each row:
    ``json`` (raw text), ``data`` (parsed struct), ``_ts`` (parsed time),
    ``is_bad`` and ``reason``. ``from_json`` is PERMISSIVE: a malformed
    message yields a struct of NULLs, so required fields decide.

    The struct comes out of a generator (one row for each message): a filter
    on it would otherwise be pushed below the projection and parse (and
    encode) the message once for each field it tests."""
    text = raw.select(F.col("value").cast("string").alias("json"))
    parsed = text.select("json", F.explode(F.array(F.from_json("json", schema))).alias("data"))
    ts = (F.try_to_timestamp(F.col("data.event_time"), F.lit(time_format)) if time_format
          else F.try_to_timestamp(F.col("data.event_time")))
    parsed = parsed.withColumn("_ts", ts)
    required = [f.name for f in schema.fields if not f.nullable]
    missing: Column = reduce(lambda a, b: a | b, [F.col(f"data.{c}").isNull() for c in required])
    return (parsed.withColumn("is_bad", missing | F.col("_ts").isNull())
                  .withColumn("reason", F.when(missing, F.lit("missing_required_field"))
                                         .when(F.col("_ts").isNull(), F.lit("bad_event_time"))))


def parse_events(raw: DataFrame, schema=STREAM_EVENT, time_format: str | None = None,
                 keep_raw: bool = False) -> tuple[DataFrame, DataFrame]:
    """Parse a batch or streaming frame of messages. Returns ``(good, bad)``:

    * good: the schema's fields flattened, ``event_time`` as TIMESTAMP;
    * bad: malformed messages / missing required fields / unparseable
      times, with the raw text and the reason, for a quarantine sink.
    """
    tagged = tag_events(raw, schema, time_format)
    good = (tagged.filter(~F.col("is_bad"))
            .select("data.*", *(["json"] if keep_raw else []), "_ts")
            .withColumn("event_time", F.col("_ts")).drop("_ts"))
    bad = tagged.filter(F.col("is_bad")).select(F.col("json").alias("raw_value"), "reason")
    return good, bad


def with_stream_metadata(df: DataFrame, source: str = "stream", load_ts: Column | None = None) -> DataFrame:
    """Add ``processed_time`` and ``source`` (stream bronze contract)."""
    return (df.withColumn("processed_time", load_ts if load_ts is not None else F.current_timestamp())
              .withColumn("source", F.lit(source)))
