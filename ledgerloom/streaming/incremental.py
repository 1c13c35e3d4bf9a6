"""New files only: a file stream that runs until nothing is left, with the same operators for each batch.

History is appended by id, so a batch that runs again adds nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.operators.records import anti_by_key


def append_new(path: str, key: str = "id"):
    """A foreachBatch function: rows whose key the table at path doesn't have; repeats in a batch count once."""

    def batch(df: DataFrame, _: int) -> None:
        from pyspark.errors import AnalysisException

        from ledgerloom.sources.tabular import is_missing

        new = df.dropDuplicates([key])
        try:
            new = anti_by_key(new, df.sparkSession.read.parquet(path), key)
        except AnalysisException as e:
            if not is_missing(e):  # no table yet
                raise
        new.write.mode("append").parquet(path)

    return batch


def ingest(source: DataFrame, path: str, checkpoint: str, key: str = "id") -> StreamingQuery:
    return source.writeStream.foreachBatch(append_new(path, key)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_windows(events: DataFrame, late: str = "10 minutes", length: str = "5 minutes") -> DataFrame:
    """Counts and sums of values by type in tumbling windows; rows later than the watermark are left out."""
    w = events.withWatermark("ts", late).groupBy(F.window("ts", length), "event_type")
    return w.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


def stream_of(spark: SparkSession, folder: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)
