"""Delivery of predictions: each closed day once, oldest first in a batch.

A micro-batch becomes one folder of records and one of marks (node, day), both
named by the batch. A retried batch replaces its own folders; a day that an
earlier batch has delivered stays out, so that neither retries nor closed days
that arrive again reach a receiver twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .dayclose import PREDICTION_SOURCE, predictions

RECORD = "site_id string, local_date date, value string"
MARK = "site_id string, local_date date, batch_id long"


def _marks(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """Days delivered by earlier batches. The folder exists once a batch has ended."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/marks")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], MARK)
    return spark.read.schema(MARK).parquet(f"{path}/marks").where(F.col("batch_id") < batch_id)


def deliver(closed: DataFrame, batch_id: int, sites: DataFrame, path: str,
            source: str = PREDICTION_SOURCE) -> None:
    """Delivers the labelled days of one micro-batch.

    Records lie in ranges of (day, node), the oldest in the first file. They are
    written before the marks: a batch that fails in between is retried whole.
    """
    spark = closed.sparkSession
    fresh = closed.dropDuplicates(["site_id", "local_date"]).join(
        _marks(spark, path, batch_id).select("site_id", "local_date"), ["site_id", "local_date"], "left_anti"
    )
    records = predictions(fresh, sites, source)
    records.repartitionByRange("local_date", "site_id").sortWithinPartitions("local_date", "site_id").write.mode(
        "overwrite").parquet(f"{path}/records/batch_id={batch_id}")
    spark.read.schema(RECORD).parquet(f"{path}/records/batch_id={batch_id}").select("site_id", "local_date").write.mode(
        "overwrite").parquet(f"{path}/marks/batch_id={batch_id}")


def start_delivery(closed: DataFrame, sites: DataFrame, path: str, **trigger):
    """Delivery as a query over a stream of closed days."""
    return (
        closed.writeStream.foreachBatch(lambda batch, batch_id: deliver(batch, batch_id, sites, path))
        .option("checkpointLocation", f"{path}/ckpt-delivery").trigger(**trigger).start()
    )


def delivered(spark: SparkSession, path: str) -> DataFrame:
    """(site_id, local_date, value, batch_id) of all records delivered so far."""
    return spark.read.schema(RECORD + ", batch_id long").parquet(f"{path}/records")
