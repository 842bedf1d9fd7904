"""The eight script metrics, each (script_id, score) for the scripts that reach its minimums; others score 0."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from lorgnette.functions.vectors import cosine, dot, is_zero, norm, raw_cosine, unit, vector_sum
from lorgnette.operators.parser import Parsed
from lorgnette.operators.providers import Letters
from lorgnette.sources.shared import cut

#: The metrics by family, and their names.
NAMES = {"dc": "adjacent_similarity qa_relevance topic_concentration", "cc": "emotional_stability linguistic_consistency action_intention_alignment", "pr": "scene_similarity event_coherence"}
METRICS = [f"{family}{k}_{name}" for family, names in NAMES.items() for k, name in enumerate(names.split(), 1)]


def full(df: DataFrame) -> DataFrame:
    return df.where(F.coalesce(F.col("text"), F.lit("")) != "")


def embedded(texts: DataFrame, provider) -> DataFrame:
    return full(texts).withColumn("v", provider.embed(F.col("text")))


def concentration(keys: list[str], df: DataFrame, least: int, least_full: int) -> DataFrame:
    """(keys, score): 1 less the mean cosine distance to the mean of the group's non-zero vectors.

    Zero vectors add nothing to either sum. The mean cosine to the mean vector is the sum of unit vectors times the mean's direction, so one aggregation does.
    """
    g = df.groupBy(*keys).agg(F.count("*").alias("n_all"), F.count_if(~is_zero("v")).alias("n"), vector_sum("v").alias("s"), vector_sum(unit("v")).alias("u"))
    return g.where((F.col("n_all") >= least) & (F.col("n") >= least_full)).where(~is_zero("s")).select(*keys, (dot("u", "s") / (F.col("n") * norm("s"))).alias("score"))


def adjacent(df: DataFrame, similarity, keep: Column | None = None) -> DataFrame:
    """(script_id, score): the mean similarity of neighbours in order."""
    w = Window.partitionBy("script_id").orderBy("pos")
    pairs = df.withColumn("next_v", F.lead("v").over(w)).where("next_v IS NOT NULL")
    return pairs.groupBy("script_id").agg(F.avg(similarity("v", "next_v")).alias("score"))


def dc1(dialogues: DataFrame, provider=Letters()) -> DataFrame:  # noqa: B008
    return adjacent(embedded(dialogues, provider), cosine)


def dc2(dialogues: DataFrame, provider=Letters()) -> DataFrame:  # noqa: B008
    w = Window.partitionBy("script_id").orderBy("pos")
    d = embedded(dialogues, provider).withColumn("q", provider.is_question(F.col("text")))
    d = d.withColumn("next_q", F.lead("q").over(w)).withColumn("next_v", F.lead("v").over(w))
    return d.where("q AND NOT next_q").groupBy("script_id").agg(F.avg(cosine("v", "next_v")).alias("score"))


def dc3(dialogues: DataFrame, provider=Letters()) -> DataFrame:  # noqa: B008
    return concentration(["script_id"], embedded(dialogues, provider), 2, 2).withColumn("score", F.greatest("score", F.lit(0.0)))


def cc1(dialogues: DataFrame, provider=Letters(), first: int = 20) -> DataFrame:  # noqa: B008
    w = Window.partitionBy("script_id", "character").orderBy("pos")
    d = full(dialogues).repartition("script_id").withColumn("k", F.row_number().over(w)).withColumn("n", F.count("*").over(Window.partitionBy("script_id", "character")))
    d = d.where(f"k <= {first} AND n >= 2").withColumn("e", provider.emotion(F.col("character"), F.col("text"))).where("e IS NOT NULL")
    d = d.withColumn("step", F.abs(F.col("e") - F.lag("e").over(w)))
    speaker = d.groupBy("script_id", "character").agg(F.avg("step").alias("step")).where("step IS NOT NULL")
    return speaker.groupBy("script_id").agg(F.avg(clamp(1 - F.col("step") / 2)).alias("score"))


def clamp(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def cc2_speakers(dialogues: DataFrame, provider=Letters()) -> DataFrame:  # noqa: B008
    return concentration(["script_id", "character"], embedded(dialogues, provider), 3, 2).withColumn("score", clamp(F.col("score")))


def cc2(dialogues: DataFrame, provider=Letters()) -> DataFrame:  # noqa: B008
    return cc2_speakers(dialogues, provider).groupBy("script_id").agg(F.avg("score").alias("score"))


#: Vectors of a script that are compared in one place: those of more are cut into shards, and each pair of shards is a task's.
SHARD, COMPARED = 8192, 256


def in_order(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """u <= v as Spark has it: NaN is above all numbers and equals itself."""
    return np.isnan(v) | (u <= v)


def greatest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each row of ``a`` its greatest cosine to a row of ``b``; a quotient that is no number counts 1 for close vectors, else 0."""
    with np.errstate(all="ignore"):
        n, m = np.sqrt((a * a).sum(axis=1)), np.sqrt((b * b).sum(axis=1))
        out = np.full(len(a), -np.inf)
        for k in range(0, len(a), COMPARED):
            x = (a[k : k + COMPARED] @ b.T) / (n[k : k + COMPARED, None] * m)
            for i in np.flatnonzero(np.isnan(x).any(axis=1)):
                near = in_order(np.abs(a[k + i] - b), 1e-6 + 1e-5 * np.abs(b)).all(axis=1)
                x[i] = np.where(np.isnan(x[i]), near.astype(float), x[i])
            out[k : k + COMPARED] = x.max(axis=1)
    return out


def by_length(v: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix) of the vectors of each length."""
    sizes = pc.list_value_length(v).to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == sizes[0]).all():
        return [(np.arange(len(sizes)), v.flatten().to_numpy(zero_copy_only=False).reshape(len(sizes), -1))]
    places = [np.flatnonzero(sizes == d) for d in np.unique(sizes)]
    return [(at, v.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1)) for at in places]


def best_match(left: DataFrame, right: DataFrame) -> DataFrame:
    """(script_id, pos, best): for each vector of ``left`` its greatest similarity to one of ``right`` in the same script, zero vectors aside.

    All pairs are compared, as products of matrices. Scripts of many vectors are cut into shards, so no task holds more than two
    of them; vectors of different lengths have no similarity, nor have those with nulls.
    """
    usable = lambda df: df.where(~is_zero("v") & F.col("script_id").isNotNull() & ~F.exists("v", lambda x: x.isNull()))
    place = [k for k in ("pos", "v") if k in right.columns]
    no_pos = F.lit(None).cast(left.schema["pos"].dataType).alias("pos")
    a = usable(left).select("script_id", "pos", F.col("v").cast("array<double>").alias("v"), F.lit(1).alias("side"), F.xxhash64("pos", "v").alias("h"))
    b = usable(right).select("script_id", no_pos, F.col("v").cast("array<double>").alias("v"), F.lit(0).alias("side"), F.xxhash64(*place).alias("h"))
    rows = a.unionByName(b)
    counts = rows.groupBy("script_id").agg(F.ceil(F.count_if(F.col("side") == 1) / SHARD).alias("n_left"), F.ceil(F.count_if(F.col("side") == 0) / SHARD).alias("n_right"))
    # At most a row for each shard.
    large = F.broadcast(cut(counts.where("n_left > 1 OR n_right > 1").withColumnRenamed("script_id", "key")))
    rows = rows.join(large, F.col("script_id") == F.col("key"), "left").drop("key")
    n_own, n_other = (F.coalesce(F.when(F.col("side") == s, F.col("n_left")).otherwise(F.col("n_right")), F.lit(1)) for s in (1, 0))
    rows = rows.withColumn("own", F.pmod("h", n_own)).withColumn("other", F.explode(F.sequence(F.lit(0), F.greatest(n_other, F.lit(1)) - 1)))
    s, t = (F.when(F.col("side") == k, F.col("own")).otherwise(F.col("other")).cast("int") for k in (1, 0))
    rows = rows.select("script_id", s.alias("s"), t.alias("t"), "side", "pos", "v")
    keys = ["script_id", "s", "t"]
    # A number of partitions keeps small ones apart: comparing takes far longer than reading.
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n, *keys).sortWithinPartitions(*keys, "side")

    def compare(batches):
        key, held = None, []  # a group's vectors of the right come first
        for batch in batches:
            if not batch.num_rows:
                continue
            differs = np.zeros(batch.num_rows - 1, bool)
            for k in (*keys, "side"):
                x = batch.column(k)
                differs |= pc.not_equal(x[1:], x[:-1]).to_numpy(zero_copy_only=False)
            edge = [0, *(np.flatnonzero(differs) + 1).tolist(), batch.num_rows]
            ids, positions, best = [], [], []
            for lo, hi in zip(edge[:-1], edge[1:], strict=True):
                part = batch.slice(lo, hi - lo)
                its, side = tuple(part.column(k)[0].as_py() for k in keys), part.column("side")[0].as_py()
                if its != key:
                    key, held = its, []
                if side == 0:
                    held += [x for _, x in by_length(part.column("v"))]
                    continue
                lengths = {x.shape[1] for x in held}
                held = [np.concatenate([x for x in held if x.shape[1] == d]) if sum(x.shape[1] == d for x in held) > 1 else next(x for x in held if x.shape[1] == d) for d in lengths]
                for at, x in by_length(part.column("v")):
                    for other in held:
                        if other.shape[1] == x.shape[1]:
                            ids.append(part.column("script_id").take(pa.array(at)))
                            positions.append(part.column("pos").take(pa.array(at)))
                            best.append(greatest(x, other))
            if best:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(ids), pa.concat_arrays(positions), pa.array(np.concatenate(best))], ["script_id", "pos", "best"])

    found = rows.mapInArrow(compare, StructType([rows.schema["script_id"], rows.schema["pos"], StructField("best", DoubleType())]))
    best = found.groupBy("script_id", "pos").agg(F.max("best").alias("best"))
    return best.where("best > 0").withColumn("best", F.least("best", F.lit(1.0)))


def cc3(dialogues: DataFrame, actions: DataFrame, provider=Letters(), first: int = 30) -> DataFrame:  # noqa: B008
    """Frames without a column ``v`` are embedded here, once: what is kept in the shared folder is read by all that follows."""
    k = F.row_number().over(Window.partitionBy("script_id").orderBy("pos"))
    wanted = full(dialogues.withColumn("k", k).where(f"k <= {first}")).where(provider.has_intent(F.col("text")))
    left, right = (x if "v" in x.columns else cut(embedded(x, provider).select("script_id", "pos", "v")) for x in (wanted, full(actions)))
    return best_match(left, right).groupBy("script_id").agg(F.avg("best").alias("score"))


def pr1(scenes: DataFrame, provider=Letters()) -> DataFrame:  # noqa: B008
    return dc1(scenes, provider)


def events_of(scenes: DataFrame, actions: DataFrame, provider=Letters(), separator: str = "\n---\n") -> DataFrame:  # noqa: B008
    """(script_id, pos, text): events told from the scenes, or from the actions of a script without any."""
    texts = full(scenes).select("script_id", F.lit(0).alias("from"), "pos", "text").unionByName(full(actions).select("script_id", F.lit(1).alias("from"), "pos", "text"))
    joined = texts.groupBy("script_id").agg(F.min("from").alias("least"), F.array_sort(F.collect_list(F.struct("from", "pos", "text"))).alias("t"))
    chosen = F.filter("t", lambda x: x["from"] == F.col("least"))
    joined = joined.select("script_id", F.array_join(F.transform(chosen, lambda x: x["text"]), separator).alias("text"))
    return joined.select("script_id", F.posexplode(provider.events(F.col("text"))).alias("pos", "text"))


def pr2(scenes: DataFrame, actions: DataFrame, provider=Letters()) -> DataFrame:  # noqa: B008
    return adjacent(embedded(events_of(scenes, actions, provider), provider), raw_cosine)


def dialogue_scores(d: DataFrame, provider=Letters(), first: int = 20) -> DataFrame:  # noqa: B008
    """(script_id, dc1 to cc2): the five metrics of dialogues alone, of embedded ones.

    One shuffle by script serves the windows over scripts and speakers, the sums by speaker and those by script.
    """
    d = d.repartition("script_id").withColumn("q", provider.is_question(F.col("text")))
    script, speaker = Window.partitionBy("script_id").orderBy("pos"), Window.partitionBy("script_id", "character").orderBy("pos")
    d = d.withColumn("next_v", F.lead("v").over(script)).withColumn("next_q", F.lead("q").over(script))
    d = d.withColumn("k", F.row_number().over(speaker)).withColumn("n", F.count("*").over(Window.partitionBy("script_id", "character")))
    d = d.withColumn("e", F.when((F.col("k") <= first) & (F.col("n") >= 2), provider.emotion(F.col("character"), F.col("text"))))
    d = d.withColumn("step", F.abs(F.col("e") - F.last("e", ignorenulls=True).over(speaker.rowsBetween(Window.unboundedPreceding, -1))))
    d = d.withColumn("near", F.when(F.col("next_v").isNotNull(), cosine("v", "next_v"))).withColumn("answers", F.col("q") & ~F.col("next_q"))
    s = d.groupBy("script_id", "character").agg(
        F.count("*").alias("n_all"), F.count_if(~is_zero("v")).alias("n"), vector_sum("v").alias("s"), vector_sum(unit("v")).alias("u"), F.avg("step").alias("step"),
        F.sum("near").alias("near"), F.count("near").alias("n_near"), F.sum(F.when(F.col("answers"), F.col("near"))).alias("qa"), F.count(F.when(F.col("answers"), F.col("near"))).alias("n_qa"),
    )
    at_centre = lambda n_all: F.when((F.col("n_all") >= n_all) & (F.col("n") >= 2) & ~is_zero("s"), dot("u", "s") / (F.col("n") * norm("s")))
    s = s.withColumn("alike", clamp_known(at_centre(3))).withColumn("calm", clamp_known(1 - F.col("step") / 2))
    total = s.groupBy("script_id").agg(
        F.sum("n_all").alias("n_all"), F.sum("n").alias("n"), vector_sum("s").alias("s"), vector_sum("u").alias("u"), F.avg("alike").alias(METRICS[4]), F.avg("calm").alias(METRICS[3]),
        F.try_divide(F.sum("near"), F.sum("n_near")).alias(METRICS[0]), F.try_divide(F.sum("qa"), F.sum("n_qa")).alias(METRICS[1]),
    )
    return total.select("script_id", METRICS[0], METRICS[1], F.when(at_centre(2).isNotNull(), F.greatest(at_centre(2), F.lit(0.0))).alias(METRICS[2]), METRICS[3], METRICS[4])


def clamp_known(x: Column) -> Column:
    return F.when(x.isNotNull(), clamp(x))


def score(parsed: Parsed, provider=Letters()) -> DataFrame:  # noqa: B008
    """(script_id, regex_parsing_successful, the eight metrics): one row for each script, 0 where a metric has too little to go by."""
    return score_texts(parsed.scripts, parsed.long(), provider)


def score_texts(scripts: DataFrame, long: DataFrame, provider=Letters()) -> DataFrame:  # noqa: B008
    """Of ``scripts`` (script_id, parsed) and ``long`` (script_id, kind, pos, character, text), as ``Parsed.long`` gives it.

    Texts are parsed and embedded in one pass, which is kept in the shared folder for the metrics to read.
    """
    e = cut(long.withColumn("v", provider.embed(F.col("text"))))
    d, s, a = (e.where(F.col("kind") == k).drop("kind") for k in "dsa")
    # One aggregation over the metrics' rows, instead of a join for each of them.
    scores = dialogue_scores(full(d), provider)
    for name, m in zip(METRICS[5:], [cc3(d, a, provider), adjacent(full(s), cosine), pr2(s, a, provider)], strict=True):
        scores = scores.unionByName(m.select("script_id", F.col("score").alias(name)), allowMissingColumns=True)
    out = scripts.select("script_id", "parsed").join(scores, "script_id", "left")
    best = [F.coalesce(F.max(F.when(~F.isnan(m), F.col(m))), F.lit(0.0)) for m in METRICS]
    return out.groupBy("script_id").agg(F.max("parsed").alias("regex_parsing_successful"), *[F.when(F.max("parsed") == 1, x).otherwise(0.0).alias(m) for m, x in zip(METRICS, best, strict=True)])
