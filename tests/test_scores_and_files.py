"""Score tables, sources, sinks, entries and the stream."""

import json
import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from lorgnette.operators import scores as S
from lorgnette.operators.metrics import METRICS
from lorgnette.plans.pipelines import Analyse, GenerateScripts, ScoreCorpus
from lorgnette.sources import files, sinks
from lorgnette.streaming.scripts import stream_scores

#: Published scores and ratings of fifteen systems, in hundredths, ties among them.
RATINGS = {
    "dc": ("87 0 3 55 56 31 6 19 86 89 88 89 90 88 90", "300 167 146 142 113 146 129 125 350 358 350 342 350 342 317"),
    "cc": ("84 0 2 43 43 14 1 12 76 82 81 83 82 82 77", "266 121 133 129 104 133 121 167 333 358 342 342 342 350 325"),
    "pr": ("91 45 46 58 55 75 51 60 93 93 93 92 92 92 90", "333 121 121 125 142 129 125 121 325 333 350 350 358 350 342"),
}


def test_rank_correlations_of_published_ratings(spark):
    cols = {f"{k}_{side}": [int(x) / 100 for x in v.split()] for k, pair in RATINGS.items() for side, v in zip("ah", pair, strict=True)}
    df = spark.createDataFrame(pd.DataFrame(cols))
    for k, want in (("dc", 0.6985), ("cc", 0.7683), ("pr", 0.7822)):
        r = S.spearman(df, f"{k}_a", f"{k}_h").first()
        assert abs(r["rho"] - want) < 5e-5 and r["n"] == 15 and 0 < r["p_value"] < 0.01
    r = S.overall(df, ["dc_a", "cc_a", "pr_a"], ["dc_h", "cc_h", "pr_h"]).first()
    assert abs(r["rho"] - 0.8065) < 5e-5


def test_p_values(spark):
    # Known values of the two-sided t-test: n = 12, t = 2.228 is the 5 % point of 10 degrees of freedom.
    t = 2.2281388519649385
    rho = t / math.sqrt(10 + t * t)
    df = spark.createDataFrame([(rho, 12), (1.0, 5), (0.0, 9), (None, 5), (0.5, 2)], "rho double, n bigint")
    got = [r["p"] for r in df.select(S.t_tail("rho", "n").alias("p")).collect()]
    assert abs(got[0] - 0.05) < 1e-9 and got[1] == 0.0 and abs(got[2] - 1) < 1e-12 and got[3] is None and got[4] is None


def test_spearman_is_invariant_and_matches_pandas(spark):
    rng = np.random.default_rng(1)
    p = pd.DataFrame({"a": rng.integers(0, 20, 300).astype(float), "b": rng.normal(size=300).round(1)})
    df = spark.createDataFrame(p).repartition(5)
    want = p["a"].rank().corr(p["b"].rank())
    assert abs(S.spearman(df, "a", "b").first()["rho"] - want) < 1e-12
    assert abs(S.spearman(df.withColumn("a", F.exp("a")), "a", "b").first()["rho"] - want) < 1e-12


def test_averages(spark):
    rows = [("x", "1", "0.5", None), ("x", "2", "bad", ""), ("x", "3", "1_0", "z"), ("y", "4", "nan", "2")]
    df = spark.createDataFrame([(f, n, a, b) for f, n, a, b in rows], "file string, line_number string, m1 string, m2 string")
    got = {r["file"]: r for r in S.averages(df).collect()}
    assert got["x"]["m1"] == 5.25 and got["x"]["m2"] == 0.0 and math.isnan(got["y"]["m1"]) and got["y"]["m2"] == 2.0
    assert S.averages(df).columns == ["file", "m1", "m2"]


def test_genres_keep_last_and_duplicates(spark):
    scores = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0), ("d", 4.0)], "imdb_id string, s double")
    genres = spark.createDataFrame([("a", ["X"], 0), ("a", ["Y", "Y"], 1), ("b", [], 2), ("c", ["X"], 3)], "imdb_id string, genres array<string>, pos int")
    assert sorted((r["imdb_id"], r["genre"]) for r in S.with_genres(scores, genres).collect()) == [("a", "Y"), ("a", "Y"), ("c", "X")]


def test_distributions(spark):
    rng = np.random.default_rng(2)
    x = np.append(rng.normal(size=200), [15, -12])
    df = spark.createDataFrame([("g", float(v)) for v in x] + [("h", 1.0), ("h", float("nan")), ("i", None)], "g string, v double")
    r = {r["g"]: r for r in S.box(df, ["g"], "v").collect()}
    q1, q2, q3 = np.quantile(x, [0.25, 0.5, 0.75])
    inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
    assert np.allclose([r["g"][k] for k in ("q1", "median", "q3", "low", "high", "mean")], [q1, q2, q3, inside.min(), inside.max(), x.mean()]) and r["g"]["n_outliers"] == len(x) - len(inside)
    assert r["h"]["n"] == 1 and r["h"]["mean"] == 1.0 and set(r) == {"g", "h"}
    m = S.mean_and_std(df.where("g = 'h' AND NOT isnan(v)").select("g", F.col("v").alias("score")), ["g"]).first()
    assert m["mean"] == 1.0 and m["std"] is None
    rows = spark.createDataFrame([(1.0, float("nan")), (None, None), (1.0, 2.0)], "a double, b double")
    assert [r[0] for r in rows.select(S.row_mean(["a", "b"])).collect()] == [1.0, None, 1.5]


def test_charts_data(spark):
    df = spark.createDataFrame([("m", "base", 0.1, 1), ("m", "base", 0.2, 2), ("n", "rag", 0.5, 1), ("o", "odd", 1.0, 1)], "model string, a string, v double, k int")
    got = [tuple(r) for r in S.ablation_pivot(df, "model", "a", "v", "k", ["base", "rag", "instruction"]).collect()]
    assert got == [("m", 0.2, None, None), ("n", None, 0.5, None)]
    axis = lambda *x: tuple(round(v, 9) for v in S.axis_range(spark.createDataFrame([(v,) for v in x], "v double"), ["v"]).first())
    assert axis(0.2, 0.6) == (0.16, 0.64) and axis(0.5, 0.5) == (0.4, 0.6) and axis(0.5, 0.51) == (0.48, 0.53) and axis(0.01, 1.04) == (0.0, 1.05) and axis(2.0, 2.0) == (0.95, 1.05)
    off = {r[0]: round(r[1], 9) for r in S.offsets(df, "model").collect()}
    assert off == {"m": -0.3, "n": 0.0, "o": 0.3} and S.offsets(df.limit(1), "model").first()["offset"] == -0.3
    diff = {r["model"]: r["mean_step"] for r in S.sequence_diff(df, ["model"], ["k"], "v").collect()}
    assert abs(diff["m"] - 0.1) < 1e-12 and diff["n"] is None


def corpus(tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    scene = "<scene><stage_direction>Night</stage_direction><character>Ann</character><dialogue>We go é</dialogue><character>Bob</character><dialogue>No way</dialogue></scene>"
    lines = [json.dumps({"movie_name": "A", "imdb_id": "t1", "script_segment": scene}), "  ", "{bad", json.dumps({"script_segment": 5}), json.dumps({"movie_name": None, "imdb_id": "t5"}), "7"]
    (tmp_path / "in" / "gt.jsonl").write_text("\n".join(lines))
    array = [{"movie_name": "B", "imdb_id": "t2", "response": f"```xml\n<script>{scene}</script>\n```"}, {"response": None}]
    (tmp_path / "in" / "sub" / "gen.json").write_text(json.dumps(array, indent=1))
    (tmp_path / "in" / "broken.json").write_text("[{]")
    (tmp_path / "in" / "mixed.json").write_text('[{"movie_name": "x"}, 3]')
    (tmp_path / "in" / "other.txt").write_text("[]")
    return str(tmp_path / "in")


def test_read_scripts(spark, tmp_path):
    got = {}
    for r in files.read_scripts(spark, [f" {corpus(tmp_path)} "]).collect():
        got.setdefault(r["source_file"].rsplit("/", 1)[1], []).append((r["line_number"], r["physical_line"], r["movie_name"], r["imdb_id"], r["script_segment"][:7]))
    assert sorted(got) == ["gen.json", "gt.jsonl"]
    assert sorted(got["gt.jsonl"]) == [(1, 1, "A", "t1", "<scene>"), (2, 3, "Error_Line_3", "N/A", ""), (3, 4, "Unknown_L4", "N/A", ""), (4, 5, None, "t5", ""), (5, 6, "Error_Line_6", "N/A", "")]
    assert sorted(got["gen.json"]) == [(1, 1, "B", "t2", "<scene>"), (2, 2, "Unknown_L2", "N/A", "")]


def test_entries_end_to_end(spark, tmp_path):
    folder = corpus(tmp_path)
    table = ScoreCorpus(folder, str(tmp_path / "out")).run(spark)
    rows = {(r["source_file"].rsplit("/", 1)[1], r["line_number"]): r for r in table.collect()}
    assert rows[("gt.jsonl", 1)]["regex_parsing_successful"] == 1 and rows[("gt.jsonl", 1)]["dc1_adjacent_similarity"] > 0 and rows[("gt.jsonl", 2)]["regex_parsing_successful"] == 0
    assert all(rows[("gt.jsonl", 1)][m] == rows[("gen.json", 1)][m] for m in METRICS)
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert back.count() == 7 and back.columns[:-1] == sinks.SCORE_COLUMNS

    flat = tmp_path / "flat"
    flat.mkdir()
    for name, v in (("m_base.csv", "0.25"), ("m_rag.csv", "0.75"), ("zz.csv", "1")):
        (flat / name).write_bytes(("movie_name,imdb_id,line_number,pr1\r\n" + f'"A, ""q""",t1,1,{v}\r\nB,t2,2,{v}\r\n').encode())
    (flat / "deep").mkdir()
    (flat / "deep" / "n_base.csv").write_text("movie_name,imdb_id,line_number,pr1\nA,t1,1,9\n")
    (tmp_path / "info.json").write_text(json.dumps({"individual_results": [{"imdb_id": "t1", "genres": ["Drama", "War"]}, {"imdb_id": "t9", "genres": ["War"]}]}, indent=2))
    a = Analyse(str(flat), str(tmp_path / "info.json"))
    assert {r["file"]: r["pr1"] for r in a.averages(spark).collect()} == {"m_base.csv": 0.25, "m_rag.csv": 0.75, "zz.csv": 1.0}
    assert [tuple(r) for r in a.ablations(spark, "pr1").collect()] == [("m", 0.25, 0.75, None)]
    genres = a.by_genre(spark)
    assert sorted((r["movie_name"], r["genre"]) for r in genres.collect() if r["file"] == "zz.csv") == [('A, "q"', "Drama"), ('A, "q"', "War")]
    sinks.write_by_genre(genres, str(tmp_path / "genres"))
    sinks.write_averages(a.averages(spark), str(tmp_path / "avg"))
    assert (tmp_path / "genres" / "genre=War").is_dir() and spark.read.option("header", True).csv(str(tmp_path / "avg")).columns == ["file", "pr1"]


def test_generate(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text("\n".join(json.dumps({"movie_name": f"M{i}", "imdb_id": f"t{i}", "summary": "s", "x": 1}) for i in range(3)))
    spark.createDataFrame([("M0", "t0", "gpt-1", "base", "kept")], "movie_name string, imdb_id string, model string, version string, response string").write.parquet(str(tmp_path / "cache"))
    out = GenerateScripts(str(tmp_path / "m.jsonl"), ["gpt-1", "gemini"], ["base"], lambda m, p: m + p[:5], str(tmp_path / "cache"), tasks=2).run(spark).collect()
    assert len(out) == 6 and {r["response"] for r in out if r["imdb_id"] == "t0" and r["model"] == "gpt-1"} == {"kept"}
    sinks.write_responses(spark.createDataFrame(out), str(tmp_path / "resp"))
    assert spark.read.json(str(tmp_path / "resp")).count() == 6
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "tt1.txt").write_text("hello\nthere")
    assert [tuple(r) for r in files.read_cache(spark, str(tmp_path / "t")).collect()] == [("tt1", "hello\nthere")]


def test_stream_scores_new_files_once(spark, tmp_path):
    folder = corpus(tmp_path)
    args = (spark, folder, str(tmp_path / "out"), str(tmp_path / "check"))
    stream_scores(*args).awaitTermination()
    first = spark.read.parquet(str(tmp_path / "out")).count()
    (tmp_path / "in" / "new.jsonl").write_text(json.dumps({"movie_name": "N", "imdb_id": "t8", "script_segment": "words"}))
    stream_scores(*args).awaitTermination()
    again = spark.read.parquet(str(tmp_path / "out"))
    assert (first, again.count()) == (7, 8)
    batch = {(r["movie_name"], r["imdb_id"]) for r in again.collect()}
    assert ("N", "t8") in batch and ("A", "t1") in batch
