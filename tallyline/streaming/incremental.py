"""Month-wise incremental loading as file streams: the batch rules applied to newly arrived files only."""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tallyline import schemas
from tallyline.functions import exprs as X
from tallyline.plans import bronze, quality, silver
from tallyline.sources import lake as L
from tallyline.sources import raw_csv


FILES_PER_BATCH = 100


def stream_ingest(spark: SparkSession, raw_folder: str, bronze_path: str, silver_path: str, checkpoint: str,
                  shift_days: int = raw_csv.SHIFT_DAYS, quarantine_path: str | None = None) -> StreamingQuery:
    """Load the raw files that are new since the last run, then stop. Bronze is the folder the batch form keeps, month by month.

    The stream only names new files. Each is then read as the batch form reads it, by its own header, so columns may come
    in any order. Rows that cannot be dated or typed go to ``quarantine_path`` (default: beside bronze) with their reasons; the
    others join the rows their months have, and every touched silver month is rebuilt. A batch is first written whole, with
    the rows its months had before, and only then replaces those months. So a batch that is repeated after a crash replaces
    them with the same rows again, at whatever point it stopped. Audit rows follow the months; one batch writes its own once.
    """
    held_back = quarantine_path or f"{bronze_path.rstrip('/')}_quarantine"
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        files = [r["file_path"] for r in batch.distinct().collect()]
        if not files:
            return
        own = f"{bronze_path}/_stream/{stream}/{batch_id}"
        if not L.is_complete(session, f"{own}/typed"):
            raw = reduce(DataFrame.unionByName, [raw_csv.read_raw(session, f) for f in sorted(files)])
            raw_csv.normalize(raw, shift_days).write.mode("overwrite").parquet(f"{own}/typed")
        typed = session.read.schema(schemas.BRONZE).parquet(f"{own}/typed")
        readable, rejected = quality.split_unreadable(typed)
        rejected.write.mode("overwrite").parquet(f"{held_back}/{stream}/{batch_id}")
        if not L.is_complete(session, f"{own}/months"):
            touched = [r["year_month"] for r in readable.select("year_month").distinct().collect()]
            stored = set(L.list_months(session, bronze_path)) & set(touched)
            merged = readable
            if stored:
                before = session.read.parquet(bronze_path).filter(F.col("year_month").isin(*stored))
                merged = readable.unionByName(schemas.conform(before, schemas.BRONZE))
            merged.write.mode("overwrite").parquet(f"{own}/months")
        merged = session.read.schema(schemas.BRONZE).parquet(f"{own}/months")
        months = [r["year_month"] for r in merged.select("year_month").distinct().collect()]
        if months:
            L.write_months(merged, bronze_path)
            bronze.ingestion_audit(merged, ", ".join(sorted(f.rsplit("/", 1)[-1] for f in files))).write.mode("overwrite").parquet(f"{own}/audit")
            L.write_months(silver.to_silver(merged), silver_path, laid_out=True)

    arrived = (spark.readStream.schema("line string").option("maxFilesPerTrigger", FILES_PER_BATCH).text(raw_folder)
               .select("_metadata.file_path"))
    return (arrived.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def stream_audit(spark: SparkSession, bronze_path: str) -> DataFrame:
    """The audit rows of all batches of all streams into ``bronze_path``."""
    return spark.read.parquet(f"{bronze_path}/_stream/*/*/audit")


def event_time(lines: DataFrame, delay: str) -> DataFrame:
    """Watermarks need a zoned timestamp; the session is expected to run in UTC (see ``build_session``)."""
    return lines.withColumn("event_time", F.col("invoice_date").cast("timestamp")).withWatermark("event_time", delay)


def stream_kpi(lines: DataFrame, window: str = "7 days", delay: str = "1 day") -> DataFrame:
    """Purchase revenue and lines per tumbling event-time window; a window comes out once the watermark passes it."""
    valid = silver.valid_purchase_rows(lines)
    return event_time(valid, delay).groupBy(F.window("event_time", window)).agg(
        X.exact_sum("line_amount").alias("revenue"), F.count(F.lit(1)).alias("lines")).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "revenue", "lines")


def stream_dedup(lines: DataFrame, delay: str = "7 days") -> DataFrame:
    """Drop repeated business records that arrive within the delay; state older than that is forgotten."""
    return event_time(lines, delay).dropDuplicatesWithinWatermark(schemas.BUSINESS_COLUMNS)


def run_to_table(df: DataFrame, path: str, checkpoint: str) -> None:
    """Process what is there, append it to a table, and stop."""
    query = (df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
