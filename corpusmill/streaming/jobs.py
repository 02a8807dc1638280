"""Streaming forms: incremental cleaning, first-seen records, event-time counts of job states."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.clean import clean


def cleaned(stream: DataFrame, text_col: str = "text") -> DataFrame:
    """Stateless: works on a stream as on a table."""
    return stream.withColumn(text_col, clean(F.col(text_col)))


def first_seen(stream: DataFrame, key: str, time: str, delay: str = "1 day") -> DataFrame:
    """The first row of each key; state is dropped once the watermark has passed it."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def state_counts(stream: DataFrame, time: str, state: str, width: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Rows by window and state, late ones up to the delay."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, width), state).agg(F.count("*").alias("rows")).select(F.col("window.start").alias("start"), state, "rows")
