"""Vectorise newly arriving catalogue items with a stored vocabulary (foreachBatch)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.tfidf import TfidfModel, transform_items


def vectorise_batch(model: TfidfModel, batch: DataFrame, out_path: str, batch_id: int) -> None:
    """One micro-batch: weights of the new items in the batch's own folder; a batch tried again replaces it."""
    transform_items(model, batch).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")


def start_item_vectoriser(spark: SparkSession, model: TfidfModel, in_path: str, schema, out_path: str,
                          checkpoint: str, trigger_once: bool = False):
    """Stream new catalogue Parquet files from ``in_path``; write their weights to ``out_path/batch_id=…``.

    ``checkpoint`` must be on shared storage (offsets and commits survive
    driver and executor loss).  With ``trigger_once`` the query processes what
    is available and stops.
    """
    stream = spark.readStream.schema(schema).parquet(in_path)
    writer = (stream.writeStream
              .foreachBatch(lambda df, epoch_id: vectorise_batch(model, df, out_path, epoch_id))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if trigger_once else writer
    return writer.start()
