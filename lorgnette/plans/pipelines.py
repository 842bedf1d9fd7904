"""The three entries: score a corpus, generate scripts, analyse score tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorgnette.functions.text import PROMPTS, file_ablation, file_model, prompt
from lorgnette.operators import metrics, parser, providers, scores
from lorgnette.sources import files, sinks


@dataclass
class ScoreCorpus:
    """Scripts below ``input_roots`` scored into ``results``."""

    input_roots: str | list[str]
    results: str | None = None
    provider: object = field(default_factory=providers.Letters)

    def run(self, spark: SparkSession) -> DataFrame:
        entries = files.read_scripts(spark, self.input_roots)
        table = score_entries(entries, self.provider)
        if self.results:
            sinks.write_scores(table, self.results)
        return table


def score_entries(entries: DataFrame, provider) -> DataFrame:
    by_id = metrics.score(parser.parse(entries.select("script_id", "script_segment")), provider)
    return entries.join(by_id, "script_id").select("source_file", *sinks.SCORE_COLUMNS)


@dataclass
class GenerateScripts:
    """Answers for the films of ``movies`` by ``models`` under ``versions`` of the prompt; those in ``cache`` aren't asked again."""

    movies: str
    models: list[str]
    versions: list[str]
    call: Callable[[str, str], str]
    cache: str | None = None
    prompts: dict[str, str] = field(default_factory=lambda: dict(PROMPTS))
    tasks: int = 8
    attempts: int = 10
    wait: float = 60.0

    def run(self, spark: SparkSession) -> DataFrame:
        m = files.read_movies(spark, self.movies)
        asked = m.withColumn("model", F.explode(F.array(*map(F.lit, self.models)))).withColumn("version", F.explode(F.array(*map(F.lit, self.versions))))
        asked = asked.withColumn("prompt", prompt("version", F.col("movie_name"), F.col("summary"), self.prompts))
        known, keys = None, ["imdb_id", "model", "version"]
        if self.cache:
            known = spark.read.parquet(self.cache)
            asked = providers.unanswered(asked, known, keys)
        done = providers.answer(asked, self.call, self.tasks, self.attempts, self.wait)
        columns = ["movie_name", *keys, "response"]
        return done.select(*columns).unionByName(known.select(*columns)) if known is not None else done.select(*columns)


@dataclass
class Analyse:
    """Averages, genres and ablations of score tables."""

    csv: str | list[str]
    genres: str | None = None

    def averages(self, spark: SparkSession) -> DataFrame:
        return scores.averages(files.read_csv(spark, self.csv))

    def by_genre(self, spark: SparkSession) -> DataFrame:
        return scores.with_genres(files.read_csv(spark, self.csv), files.read_genres(spark, self.genres))

    def ablations(self, spark: SparkSession, metric: str) -> DataFrame:
        a = self.averages(spark).select(file_model("file").alias("model"), file_ablation("file").alias("ablation"), F.col(metric).alias("value"), "file")
        return scores.ablation_pivot(a.where("model <> ''"), "model", "ablation", "value", "file", ["base", "rag", "instruction"])
