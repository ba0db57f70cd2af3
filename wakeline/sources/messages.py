"""JSON message sources with one layout: ``value string, topic string, timestamp timestamp``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def kafka(spark: SparkSession, bootstrap: str, topics: str | list[str], streaming: bool = True,
          starting: str = "latest", **options: str) -> DataFrame:
    """Messages of one or several topics.  Keys are ignored; needs the Kafka connector package.

    ``minPartitions`` in ``options`` splits large topic partitions over more tasks.
    """
    names = topics if isinstance(topics, str) else ",".join(topics)
    reader = spark.readStream if streaming else spark.read
    df = (reader.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("subscribe", names)
          .option("startingOffsets", starting if streaming else "earliest").options(**options).load())
    return df.select(F.col("value").cast("string").alias("value"), "topic", "timestamp")


def files(spark: SparkSession, path: str, topic: str = "", streaming: bool = True,
          max_files_per_trigger: int | None = None) -> DataFrame:
    """A folder of text files with one JSON object per line; the record time is the file time."""
    reader = spark.readStream if streaming else spark.read
    reader = reader.format("text")
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.load(path)
    return df.select("value", F.lit(topic).alias("topic"), F.col("_metadata.file_modification_time").alias("timestamp"))


def rows(spark: SparkSession, values: list[str], topic: str = "") -> DataFrame:
    """A bounded in-memory source, for tests."""
    return (spark.createDataFrame([(v,) for v in values], "value string")
            .select("value", F.lit(topic).alias("topic"), F.current_timestamp().alias("timestamp")))
