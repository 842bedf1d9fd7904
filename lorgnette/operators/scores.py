"""Score tables: averages, groups, distributions, ablations and rank correlations."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from lorgnette.functions.text import python_float
from lorgnette.operators.metrics import METRICS
from lorgnette.sources.shared import cut

META = ("movie_name", "imdb_id", "line_number", "original_script", "file")
#: Groups of which a table is broadcast.
FEW = 100_000
FAMILIES = {"DC": METRICS[0:3], "CC": METRICS[3:6], "PR": METRICS[6:8]}


def long_scores(scores: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """(keys, metric, score): a row for each metric that the table has; scores that aren't numbers are left out."""
    present = [m for m in metrics if m in scores.columns]
    out = scores.select(*keys, *[F.col(m).cast("double").alias(m) for m in present]).unpivot(keys, present, "metric", "score")
    return out.where("score IS NOT NULL AND NOT isnan(score)")


def average_long(scores: DataFrame, file: str = "file") -> DataFrame:
    """(file, metric, value): the mean of all values of a column that read as numbers; NaN spreads."""
    values = [k for k in scores.columns if k not in META and k != file]
    long = scores.select(file, *[F.col(k).cast("string").alias(k) for k in values]).unpivot([file], values, "metric", "text")
    return long.withColumn("value", python_float("text")).where("value IS NOT NULL").groupBy(file, "metric").agg(F.avg("value").alias("value"))


def averages(scores: DataFrame, file: str = "file", metrics: list[str] | None = None) -> DataFrame:
    """A row for each file, a column for each metric in the order of names; a metric that a file lacks is 0.

    Metrics are the table's columns, unless listed, so no pass over the data is needed to name them.
    """
    names = sorted(metrics or [k for k in scores.columns if k not in META and k != file])
    wide = average_long(scores, file).groupBy(file).pivot("metric", names).agg(F.first("value"))
    return scores.select(file).distinct().join(wide, file, "left").select(file, *[F.coalesce(n, F.lit(0.0)).alias(n) for n in names])


def with_genres(scores: DataFrame, genres: DataFrame, key: str = "imdb_id") -> DataFrame:
    """A row for each score and genre of its film; films without genres have none. ``genres`` is (key, genres, pos); the last of a repeated key holds."""
    last = genres.groupBy(key).agg(F.max_by("genres", "pos").alias("genres"))
    return scores.join(last, key).withColumn("genre", F.explode("genres")).drop("genres")


def mean_and_std(long: DataFrame, keys: list[str]) -> DataFrame:
    return long.groupBy(*keys).agg(F.avg("score").alias("mean"), F.stddev_samp("score").alias("std"), F.count("*").alias("n"))


def families(families: dict[str, list[str]] = FAMILIES) -> Column:
    out = F.when(F.lit(False), "")
    for name, metrics in families.items():
        out = out.when(F.col("metric").isin(metrics), name)
    return out


def row_mean(metrics: list[str]) -> Column:
    """The mean of a row's metrics, those that aren't numbers aside; null if none is."""
    full = F.filter(F.array(*[F.col(m).cast("double") for m in metrics]), lambda x: x.isNotNull() & ~F.isnan(x))
    return F.try_divide(F.aggregate(full, F.lit(0.0), lambda s, x: s + x), F.size(full))


def box(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """What a box plot shows: quartiles, the farthest values within 1.5 interquartile ranges, outliers counted, the mean.

    Rows are counted by value and values put in order by a range partitioning that is kept, as for ranks, so no task holds all values of a group.
    """
    counts = df.where(F.col(value).isNotNull() & ~F.isnan(value)).groupBy(*[F.col(k).alias(f"_{k}") for k in keys], F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    mine = [f"_{k}" for k in keys]
    counts = cut(counts.repartitionByRange(*mine, "_v").withColumn("_part", F.spark_partition_id()))
    same = lambda a, b: [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(a, b, strict=True)]
    sizes = counts.groupBy(*[F.col(k).alias(f"{k}_") for k in mine], F.col("_part").alias("_part_")).agg(F.sum("_n").alias("_size"), F.sum(F.col("_v") * F.col("_n")).alias("_sum"))
    whole = Window.partitionBy(*[f"{k}_" for k in mine])
    # A row for each group and partition.
    sizes = sizes.withColumn("_before", F.sum("_size").over(whole.orderBy("_part_")) - F.col("_size")).withColumn("n", F.sum("_size").over(whole)).withColumn("mean", F.sum("_sum").over(whole) / F.col("n"))
    up = F.sum("_n").over(Window.partitionBy(*mine, "_part").orderBy("_v"))
    r = counts.withColumn("_up", up).join(sizes, [F.col("_part") == F.col("_part_"), *same(mine, [f"{k}_" for k in mine])])
    r = r.withColumn("_to", F.col("_before") + F.col("_up")).withColumn("_from", F.col("_to") - F.col("_n"))
    at = lambda k: F.max(F.when((F.col("_from") <= k) & (k < F.col("_to")), F.col("_v").cast("double")))
    ends = []
    for k, p in enumerate((0.25, 0.5, 0.75)):
        place = (F.col("n") - 1) * p
        ends += [at(F.floor(place)).alias(f"_lo{k}"), at(F.ceil(place)).alias(f"_hi{k}")]
    q = r.groupBy(*mine, "n", "mean").agg(*ends)
    between = lambda k, p: ((lambda x: F.when(F.col(f"_lo{k}") == F.col(f"_hi{k}"), F.col(f"_lo{k}")).otherwise((F.ceil(x) - x) * F.col(f"_lo{k}") + (x - F.floor(x)) * F.col(f"_hi{k}")))((F.col("n") - 1) * p))
    q = cut(q.select(*[F.col(f"_{k}").alias(k) for k in keys], "n", "mean", between(0, 0.25).alias("q1"), between(1, 0.5).alias("median"), between(2, 0.75).alias("q3")))
    wide = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("_v").between(F.col("q1") - wide, F.col("q3") + wide)
    few = F.broadcast(q) if q.count() <= FEW else q
    return (
        counts.join(few, same(mine, keys))
        .groupBy(*keys, "q1", "median", "q3", "mean", "n")
        .agg(F.min(F.when(inside, F.col("_v"))).alias("low"), F.max(F.when(inside, F.col("_v"))).alias("high"), F.coalesce(F.sum(F.when(~inside, F.col("_n"))), F.lit(0)).alias("n_outliers"))
        .select(*keys, "q1", "median", "q3", "low", "high", "mean", "n", "n_outliers")
    )


def ablation_pivot(df: DataFrame, model: str, ablation: str, value: str, order: str, ablations: list[str]) -> DataFrame:
    """model x ablations, the last row of a pair in ``order``; models with one ablation at least."""
    wide = df.where(F.col(ablation).isin(ablations)).groupBy(model).pivot(ablation, ablations).agg(F.max_by(value, order))
    return wide.where(F.coalesce(*ablations).isNotNull()).orderBy(model)


def axis_range(df: DataFrame, columns: list[str]) -> DataFrame:
    """(lower, upper): an axis for the values of ``columns``, a tenth of their range beyond them, within 0 and 1.05."""
    least = F.min(F.least(*columns)) if len(columns) > 1 else F.min(columns[0])
    most = F.max(F.greatest(*columns)) if len(columns) > 1 else F.max(columns[0])
    r = df.agg(least.alias("lo"), most.alias("hi"))
    pad = F.when(F.col("hi") == F.col("lo"), 0.1).otherwise(F.greatest((F.col("hi") - F.col("lo")) * 0.1, F.lit(0.02)))
    r = r.select(F.greatest(F.lit(0.0), F.col("lo") - pad).alias("lower"), F.least(F.lit(1.05), F.col("hi") + pad).alias("upper"))
    degenerate = F.col("upper") <= F.col("lower")
    upper = F.when(degenerate, F.when(F.col("lower") < 0.95, F.col("lower") + 0.1).otherwise(1.05)).otherwise(F.col("upper"))
    lower = F.when(degenerate, F.when(upper > 0.1, upper - 0.1).otherwise(0.0)).otherwise(F.col("lower"))
    return r.select(F.coalesce(lower, F.lit(0.0)).alias("lower"), F.coalesce(upper, F.lit(1.05)).alias("upper"))


def offsets(df: DataFrame, model: str, width: float = 0.3) -> DataFrame:
    """(model, offset): models in order of name, evenly from -width to width; a single one at -width."""
    names = df.select(model).distinct()
    n = names.agg(F.count("*").alias("n"))
    # Window.orderBy alone would bring all rows to one task; the models of a chart are a few names.
    k = names.select(model, (F.row_number().over(Window.orderBy(model)) - 1).alias("k")).crossJoin(n)
    return k.select(model, F.when(F.col("n") > 1, F.col("k") * (2 * width) / (F.col("n") - 1) - width).otherwise(-width).alias("offset"))


def ranked(df: DataFrame, value: str, name: str) -> DataFrame:
    """(value, rank) of each distinct value, ties having the mean of their ranks.

    Rows are counted by value. A range partitioning, kept so that all that follows sees the same one, then puts smaller values
    in earlier partitions, so a value's rank is its place within its partition after the sizes of those before; no task sees
    all values.
    """
    counts = cut(df.where(F.col(value).isNotNull()).groupBy(value).count().repartitionByRange(value).withColumn("part", F.spark_partition_id()))
    sizes = counts.groupBy("part").agg(F.sum("count").alias("size"))
    before = sizes.withColumn("before", F.sum("size").over(Window.orderBy("part")) - F.col("size")).drop("size")  # a row for each partition
    up = F.sum("count").over(Window.partitionBy("part").orderBy(value))
    return counts.withColumn("up", up).join(before, "part").select(F.col(value).alias(f"_{name}"), (F.col("before") + F.col("up") - (F.col("count") - 1) / 2).alias(name))


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """(rho, n, p_value) of two columns, rows with a null left out."""
    full = df.select(a, b).where(F.col(a).isNotNull() & F.col(b).isNotNull())
    ra, rb = ranked(full, a, "rank_a"), ranked(full, b, "rank_b")
    r = full.join(ra, full[a] == ra["_rank_a"]).join(rb, full[b] == rb["_rank_b"])
    s = r.agg(F.corr("rank_a", "rank_b").alias("rho"), F.count("*").alias("n"))
    return s.select("rho", "n", t_tail("rho", "n").alias("p_value"))


@F.pandas_udf(DoubleType())
def t_tail(rho: pd.Series, n: pd.Series) -> pd.Series:
    """The two-sided p-value of a correlation by the t-distribution, as a regularised incomplete beta function."""

    def beta(a: float, b: float, x: float) -> float:
        if x <= 0 or x >= 1:
            return float(x >= 1)
        if x > (a + 1) / (a + b + 2):
            return 1 - beta(b, a, 1 - x)
        front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)) / a
        # Lentz's evaluation of the continued fraction.
        f, c, d = 1.0, 1.0, 0.0
        for i in range(500):
            m = i // 2
            k = 1.0 if i == 0 else m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)) if i % 2 == 0 else -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
            d = 1 / max(abs(1 + k * d), 1e-300) * math.copysign(1, 1 + k * d)
            c = 1 + k / c if abs(c) > 1e-300 else 1e300
            f *= c * d
            if i and abs(1 - c * d) < 1e-14:
                break
        return front * (f - 1)

    def one(r, m):
        if r is None or r != r or m < 3:
            return None
        if abs(r) >= 1:
            return 0.0
        df = m - 2
        return beta(df / 2, 0.5, df / (df + r * r * df / (1 - r * r)))

    return pd.Series([one(r, m) for r, m in zip(rho, n, strict=True)], dtype="float64")


def overall(df: DataFrame, families: list[str], human: list[str]) -> DataFrame:
    """The rank correlation of the plain means of families, machine against human."""
    mean = lambda cols: sum(F.col(k) for k in cols) / len(cols)
    return spearman(df.select(mean(families).alias("machine"), mean(human).alias("human")), "machine", "human")


def counters(df: DataFrame, ok: Column, unreadable: Column) -> DataFrame:
    """(processed, unparsed, unreadable) of a run."""
    return df.agg(F.count("*").alias("processed"), F.count_if(~ok).alias("unparsed"), F.count_if(unreadable).alias("unreadable"))


def sequence_diff(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """(keys, mean_step): the mean size of steps from a value to the next in order."""
    step = F.abs(F.col(value) - F.lag(value).over(Window.partitionBy(*keys).orderBy(*order)))
    return df.withColumn("step", step).groupBy(*keys).agg(F.avg("step").alias("mean_step"))


def first_n(df: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    return df.withColumn("k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("k") <= n).drop("k")
