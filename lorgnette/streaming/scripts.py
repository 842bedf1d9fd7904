"""Scores of scripts as their files arrive. A script is one row, so each micro-batch is scored whole, with the batch plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorgnette.operators.providers import Letters
from lorgnette.plans.pipelines import score_entries
from lorgnette.sources.files import entries_of_arrays, entries_of_lines, numbered


def stream_scores(spark: SparkSession, folder: str, out: str, checkpoint: str, provider=None):
    """A query that appends to ``out`` the scores of each new JSON or JSONL file in ``folder``; ``out`` has a ``batch`` column, by which a repeated batch replaces itself."""
    files = spark.readStream.option("recursiveFileLookup", True).option("pathGlobFilter", "*.{json,jsonl}").option("wholetext", True).format("text").load(folder)
    files = files.select(F.col("_metadata.file_path").alias("source_file"), "value")

    def batch(df: DataFrame, number: int) -> None:
        lines = df.where("NOT startswith(value, '[')").select("source_file", F.posexplode(F.split("value", "\n")).alias("k", "value"))
        lines = lines.select("source_file", (F.col("k") + 1).cast("long").alias("physical_line"), "value")
        entries = numbered(entries_of_lines(lines).unionByName(entries_of_arrays(df.where("startswith(value, '[')"))))
        score_entries(entries, provider or Letters()).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
