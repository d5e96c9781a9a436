"""Monthly activity as a Structured Streaming job over arriving export files.

New transaction files dropped into a folder are read as a text stream, go
through the same rules and month key as the batch question, and update a
running (month -> count, exact sum) state kept in the checkpoint folder,
so a restarted or failed job resumes where it stopped.  Every micro-batch
publishes the complete, small result table (one row per month) as a new version
(``sources.results.publish``): a crash while writing leaves the result before it, and older
versions are deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chaintally.functions.scalar import mean_of, month_label
from chaintally.operators.validate import keep_valid, tx_value_time
from chaintally.sources.parsed import needs, parsed_transactions
from chaintally.sources.results import newest, publish

RESULT = "month string, n long, total_value decimal(38,6), avg_value double"


def monthly_totals_stream(lines: DataFrame) -> DataFrame:
    """Streaming aggregate: month, n, total_value (exact), avg_value."""
    rules = tx_value_time()
    rows = keep_valid(parsed_transactions(lines, needs(["month_no", "value"], rules)), rules)
    agg = rows.groupBy("month_no").agg(F.count(F.lit(1)).alias("n"), F.try_sum("value").alias("total_value"))
    return agg.select(month_label("month_no").alias("month"), "n", "total_value", mean_of(F.col("total_value"), F.col("n")).alias("avg_value"))


def start_monthly_value_stream(spark: SparkSession, source_dir: str, out_dir: str,
                               checkpoint_dir: str, max_files_per_trigger: int = 64,
                               available_now: bool = False):
    """Start the stream; returns the ``StreamingQuery``."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(source_dir)
    result = monthly_totals_stream(lines)

    def write_batch(batch: DataFrame, epoch: int) -> None:
        publish(batch.sparkSession, out_dir, batch.write.parquet)

    writer = (result.writeStream.outputMode("complete")
              .option("checkpointLocation", checkpoint_dir)
              .foreachBatch(write_batch))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def run_monthly_value_stream(spark: SparkSession, source_dir: str, work_dir: str) -> DataFrame:
    """Process every file present now, then return the monthly table
    (month, n, avg_value) as the batch question does."""
    out_dir = f"{work_dir}/result"
    query = start_monthly_value_stream(spark, source_dir, out_dir, f"{work_dir}/checkpoint",
                                       available_now=True)
    query.awaitTermination()
    return newest_result(spark, out_dir).select("month", "n", "avg_value").orderBy("month")


def newest_result(spark: SparkSession, out_dir: str) -> DataFrame:
    """The table of the newest micro-batch that was written whole; an empty one where none was."""
    folder = newest(spark, out_dir)
    if folder == out_dir:
        return spark.createDataFrame([], RESULT)
    return spark.read.parquet(folder)
