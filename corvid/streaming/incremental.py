"""Merges a stream of captured pages into a corpus kept as changes, batch by batch, exactly once.

A batch of n pages writes what it changes, at most n rows, as one commit that bears the batch's name: the stream's own id and its number. A batch whose
commit is in is passed over when Spark runs it again. A new checkpoint is a new id: it goes on from what is there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..plans.run import site_changes
from ..plans.sites import SiteSpec
from ..sources.changelog import ChangeLog


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    return spark.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id")).first()[0]


def merge_stream(pages: DataFrame, spec: SiteSpec, candidates: DataFrame, corpus: str, checkpoint: str, run_ts: Column, mode: str = "intent") -> DataStreamWriter:
    """pages: a stream of (url, html[, inner_text]). corpus: the folder of a ChangeLog. Start it with .start(), or
    .trigger(availableNow=True).start()."""

    def merge_batch(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        log = ChangeLog(spark, corpus)
        log.commit(site_changes(spec, candidates, batch, log.held(), run_ts, mode=mode), f"{_stream_id(spark, checkpoint)}-{number}")

    return pages.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
