"""Scripts, scores, genres and films from files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lorgnette.functions.text import strip, unwrap
from lorgnette.operators.metrics import METRICS
from lorgnette.sources.shared import cut

MOVIES = "movie_name string, imdb_id string, summary string"
SCORES = ", ".join(f"{k} string" for k in ("movie_name", "imdb_id", "line_number", "regex_parsing_successful", *METRICS))


def roots(paths: str | list[str]) -> list[str]:
    """Folders from a list or a text with commas, white space around them aside."""
    parts = paths.split(",") if isinstance(paths, str) else paths
    return [p.strip() for p in parts if p.strip()]


def text_field(v: Column, name: str, default: Column) -> Column:
    """A field of a JSON object: its text; the default if absent; null if null; other values as JSON."""
    x = F.try_variant_get(v, f"$.{name}", "string")
    absent = F.try_variant_get(v, f"$.{name}", "variant").isNull()
    return F.when(absent, default).otherwise(x)


def only_text(v: Column, name: str) -> Column:
    """A field if it is a text, else ''."""
    x = F.try_variant_get(v, f"$.{name}", "variant")
    return F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(v, f"$.{name}", "string")).otherwise("")


def is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def entries_of_lines(lines: DataFrame) -> DataFrame:
    """Script entries from (source_file, physical_line, value): blank lines are skipped, unreadable ones become placeholders."""
    v = lines.where(strip("value") != "").withColumn("v", F.try_parse_json("value"))
    n = F.col("physical_line").cast("string")
    good = is_object(F.col("v"))
    return v.select(
        "source_file",
        "physical_line",
        F.when(good, text_field(F.col("v"), "movie_name", F.concat(F.lit("Unknown_L"), n))).otherwise(F.concat(F.lit("Error_Line_"), n)).alias("movie_name"),
        F.when(good, text_field(F.col("v"), "imdb_id", F.lit("N/A"))).otherwise(F.lit("N/A")).alias("imdb_id"),
        F.when(good, only_text(F.col("v"), "script_segment")).otherwise("").alias("script_segment"),
    )


def entries_of_arrays(files: DataFrame) -> DataFrame:
    """Script entries from (source_file, value) with a JSON array in each value; a file with bad JSON or an item that is no object has none."""
    items = F.try_parse_json("value").try_cast("array<variant>")
    a = files.withColumn("items", items)
    whole = F.coalesce(F.forall("items", lambda x: F.coalesce(F.schema_of_variant(x).startswith("OBJECT"), F.lit(False))), F.lit(False))
    a = a.where(whole).select("source_file", F.posexplode("items").alias("k", "v"))
    n = (F.col("k") + 1).cast("string")
    return a.select(
        "source_file",
        (F.col("k") + 1).cast("long").alias("physical_line"),
        text_field(F.col("v"), "movie_name", F.concat(F.lit("Unknown_L"), n)).alias("movie_name"),
        text_field(F.col("v"), "imdb_id", F.lit("N/A")).alias("imdb_id"),
        unwrap(only_text(F.col("v"), "response")).alias("script_segment"),
    )


#: Lines of a file that are numbered in one place.
STRETCH = 1 << 16


def placed(df: DataFrame, part: str, order: str, name: str) -> DataFrame:
    """``df`` with its rows numbered from 1 in each file as ``name``, by ``part`` and then ``order``: within the part, after the
    sizes of the parts before. No task holds more of a file than a part, but for the parts' sizes."""
    sizes = df.groupBy(F.col("source_file").alias("_file"), F.col(part).alias("_part")).agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.sum("_n").over(Window.partitionBy("_file").orderBy("_part")) - F.col("_n")).drop("_n")
    n = F.row_number().over(Window.partitionBy("source_file", part).orderBy(order))
    return df.withColumn("_at", n).join(before, (F.col("source_file") == F.col("_file")) & (F.col(part) == F.col("_part"))).withColumn(name, F.col("_before") + F.col("_at")).drop("_at", "_file", "_part", "_before")


def numbered(entries: DataFrame) -> DataFrame:
    """With ``line_number``, the place among a file's entries that were kept, and ``script_id``."""
    e = placed(entries.withColumn("_stretch", F.floor(F.col("physical_line") / STRETCH)), "_stretch", "physical_line", "line_number").drop("_stretch")
    return e.withColumn("line_number", F.col("line_number").cast("int")).withColumn("script_id", F.concat_ws("#", "source_file", "line_number"))


def split_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(source_file, at, k, value): the lines of all files below the roots, with the start of their split and their order in it."""
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.{json,jsonl}").text(paths)
    return raw.select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("k"), "value")


def physical_lines(spark: SparkSession, paths: list[str], leave: list[str] = ()) -> DataFrame:
    """(source_file, physical_line, value) of all files but those of ``leave``: files are split as Spark likes, lines numbered by split and place.

    Where splits begin depends on the sizes of all files that a scan reads, and a filter on names changes these. So lines are
    kept in the shared folder before they are counted and numbered, and both see the same splits.
    """
    lines = cut(split_lines(spark, paths).where(~F.col("source_file").isin(list(leave))))
    return placed(lines, "at", "k", "physical_line").select("source_file", "physical_line", "value")


def array_files(spark: SparkSession, paths: list[str]) -> list[str]:
    """The files whose first line begins with ``[``: names out of the listing that the driver has anyway."""
    first = split_lines(spark, paths).where("at = 0").groupBy("source_file").agg(F.min_by("value", "k").alias("value"))
    return sorted(r["source_file"] for r in first.where("startswith(value, '[')").select("source_file").collect())


def read_scripts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Script entries of all JSON and JSONL files below the roots. A file that begins with ``[`` is an array and read whole, any other has a JSON object on each line."""
    where = roots(paths)
    arrays = array_files(spark, where)
    rows = entries_of_lines(physical_lines(spark, where, arrays))
    if arrays:
        whole = spark.read.text(arrays, wholetext=True).select(F.col("_metadata.file_path").alias("source_file"), "value")
        rows = rows.unionByName(entries_of_arrays(whole))
    return numbered(rows)


def read_movies(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MOVIES).json(path)


def read_genres(spark: SparkSession, path: str) -> DataFrame:
    """(imdb_id, genres, pos) from one JSON object with ``individual_results``."""
    raw = spark.read.schema("individual_results array<struct<imdb_id: string, genres: array<string>>>").option("multiLine", True).json(path)
    return raw.select(F.posexplode("individual_results").alias("pos", "x")).select("x.imdb_id", "x.genres", "pos")


def read_csv(spark: SparkSession, paths: str | list[str], schema: str | None = None) -> DataFrame:
    """Tables with a header, all columns text unless a schema says otherwise, and ``file``, the name without folders. Folders aren't searched further."""
    r = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).option("pathGlobFilter", "*.csv").option("enforceSchema", False)
    r = r.schema(schema) if schema else r.option("inferSchema", False)
    return r.csv(roots(paths)).withColumn("file", F.col("_metadata.file_name"))


def stem(name: Column) -> Column:
    return F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 1)


def read_cache(spark: SparkSession, folder: str) -> DataFrame:
    """(imdb_id, response) of the answers kept as ``{imdb_id}.txt`` below a folder."""
    t = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(folder, wholetext=True)
    return t.select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.txt$", 1).alias("imdb_id"), F.col("value").alias("response"))
