"""Scores, averages and answers to files."""

from __future__ import annotations

from pathlib import PurePosixPath
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorgnette.operators.metrics import METRICS

SCORE_COLUMNS = ["movie_name", "imdb_id", "line_number", "regex_parsing_successful", *METRICS]


def write_scores(scores: DataFrame, path: str, root: str | None = None) -> None:
    """Score tables with the fixed header, one for each source file; files without entries have none.

    They are folders named after the source files; with ``root``, single files at the sources' places below it, with ``.csv``
    for their endings. Sources that differ in their endings alone share a place, and the last in order of name has it.
    """
    filled = scores.select("source_file", *SCORE_COLUMNS).fillna(0.0, METRICS)
    filled.repartition("source_file").sortWithinPartitions("source_file", "line_number").write.mode("overwrite").partitionBy("source_file").option("header", True).option("lineSep", "\r\n").csv(path)
    if root is not None:
        mirrored(scores.sparkSession, path, root)


def mirrored(spark: SparkSession, path: str, root: str) -> None:
    """Renames each ``source_file=...`` folder's table to its source's place below ``root``: one move a file, no data read."""
    jvm = spark.sparkContext._jvm
    to = jvm.org.apache.hadoop.fs.Path(path)
    fs = to.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    below = jvm.org.apache.hadoop.fs.Path(root).toUri().getPath().rstrip("/") + "/"
    for folder in sorted(fs.listStatus(to), key=lambda s: unquote(s.getPath().getName())):
        if not folder.getPath().getName().startswith("source_file="):
            continue
        source = unquote(unquote(folder.getPath().getName()[len("source_file=") :])).removeprefix("file:").replace("///", "/")
        place = source.removeprefix(below).lstrip("/")
        target = jvm.org.apache.hadoop.fs.Path(to, PurePosixPath(place).with_suffix(".csv").as_posix())
        for k, part in enumerate(s for s in fs.listStatus(folder.getPath()) if s.getPath().getName().endswith(".csv")):
            if k:
                raise ValueError(f"{source} has more than one table")
            fs.mkdirs(target.getParent())
            fs.delete(target, False)
            fs.rename(part.getPath(), target)
        fs.delete(folder.getPath(), True)


def write_averages(averages: DataFrame, path: str, file: str = "file") -> None:
    """One table with ``file`` and the metrics in order of name; a row for each file, so one task writes it."""
    averages.select(file, *sorted(k for k in averages.columns if k != file)).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_by_genre(scores: DataFrame, path: str, genre: str = "genre") -> None:
    scores.write.mode("overwrite").partitionBy(genre).option("header", True).csv(path)


def write_responses(responses: DataFrame, path: str) -> None:
    """Answers as JSON lines, letters beyond ASCII as they are."""
    responses.select("movie_name", "imdb_id", "response").write.mode("overwrite").json(path)


def add_to_cache(responses: DataFrame, path: str) -> None:
    """Answers that are neither empty nor errors, added to the cache table."""
    ok = (F.coalesce(F.col("response"), F.lit("")) != "") & ~F.col("response").startswith("ERROR")
    responses.where(ok).write.mode("append").parquet(path)
