"""Label fragments as a stream: files that arrive, parsed in batches, each record once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.small_files import FIELDS, records


def stream_fragments(spark: SparkSession, folder: str, per_trigger: int = 1000) -> DataFrame:
    schema = "path string, source_dataset string, size_bytes bigint, content string, modified_at timestamp_ntz"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(folder)


def new_records(fragments: DataFrame, late: str = "7 days") -> DataFrame:
    """Complete records, each label id once within the watermark: state stays bounded by it."""
    rows = records(fragments).filter("complete").withColumn("at", F.col("modified_at").cast("timestamp"))
    return rows.withWatermark("at", late).dropDuplicatesWithinWatermark(["label_id"]).select(*FIELDS, "path", "at")


def hourly(fragments: DataFrame, late: str = "1 day") -> DataFrame:
    rows = records(fragments).filter("complete").withColumn("at", F.col("modified_at").cast("timestamp"))
    return rows.withWatermark("at", late).groupBy(F.window("at", "1 hour"), "task").agg(F.count("*").alias("records"))


def write(df: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Appends what is there and ends; the checkpoint makes a repeated start take only what is new."""
    return df.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(target)
