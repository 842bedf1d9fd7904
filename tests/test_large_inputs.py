"""What only shows on larger inputs, made to show on small ones."""

import json
import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from lorgnette.operators import metrics as M
from lorgnette.operators import parser
from lorgnette.operators import scores as S
from lorgnette.sources import files


def test_lines_of_files_in_several_splits_beside_an_array(spark, tmp_path):
    """Splits of files are as large as a scan's share of all files; lines are numbered alike whatever else is in the folders."""
    lines = [json.dumps({"movie_name": f"m{k}", "script_segment": "x" * 50}) for k in range(2000)]
    (tmp_path / "a.jsonl").write_text("\n".join(lines))
    (tmp_path / "b.json").write_text(json.dumps([{"movie_name": "b", "response": "y" * len("\n".join(lines))}]))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = files.read_scripts(spark, str(tmp_path)).select("movie_name", "physical_line", "line_number").collect()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(map(tuple, got)) == sorted([("b", 1, 1)] + [(f"m{k}", k + 1, k + 1) for k in range(2000)])


def test_best_matches_over_shards(spark, monkeypatch):
    """All pairs of scripts cut into shards, against a loop; vectors of other lengths, zeros, nulls and NaN among them."""
    monkeypatch.setattr(M, "SHARD", 7)
    rng = np.random.default_rng(3)
    rows = [(s, k, rng.normal(size=3 + k % 2).tolist()) for s, n in (("a", 60), ("b", 9), ("c", 1)) for k in range(n)]
    rows += [("a", 60, [0.0, 0.0, 0.0]), ("a", 61, [1.0, None, 2.0]), ("b", 9, [math.nan, 1.0, 1.0]), ("b", 10, [math.nan, 1.0, 1.0]), ("a", 62, None), (None, 1, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "script_id string, pos int, v array<double>")
    left, right = df.where("pos % 3 = 0 OR pos = 10"), df.where("pos % 3 <> 0 OR pos = 9")

    def alike(x, y):
        if len(x) != len(y) or None in x or None in y:
            return -1.0
        x, y = np.array(x), np.array(y)
        if np.isnan(x).any() or np.isnan(y).any():
            return float(all(np.isnan(b) or abs(a - b) <= 1e-6 + 1e-5 * abs(b) for a, b in zip(x, y, strict=True)))
        return float(x @ y / np.linalg.norm(x) / np.linalg.norm(y))

    full = lambda d: [r for r in d.collect() if r["script_id"] and r["v"] and any(x for x in r["v"])]
    want = {}
    for a in full(left):
        best = max([alike(a["v"], b["v"]) for b in full(right) if b["script_id"] == a["script_id"]], default=0)
        if best > 0:
            want[a["script_id"], a["pos"]] = min(best, 1.0)
    got = {(r["script_id"], r["pos"]): r["best"] for r in M.best_match(left, right).collect()}
    assert got.keys() == want.keys() and len(got) > 15 and all(abs(got[k] - want[k]) < 1e-12 for k in got)


def test_only_marks_of_elements_go_through_python(spark):
    """Texts of elements stay out of the walk, so its memory doesn't grow with them."""
    text = "<scene><character>Ann</character><dialogue>" + "long " * 1000 + "</dialogue><parenthetical>softly</parenthetical><action>Runs.</action></scene>"
    df = spark.createDataFrame([(k, text * (k % 3 + 1) if k else None) for k in range(9)], "script_id int, script_segment string")
    marks = df.select(parser.marks_of(parser.elements_of(parser.all_of(F.col("script_segment"), parser.SCENE))).alias("m")).where("m IS NOT NULL").collect()
    assert {tuple(r["m"]) for r in marks} == {("s", "=ANN", "d", "p", "a") * k for k in (1, 2, 3)}
    p = parser.parse(df)
    got = p.dialogues.groupBy("script_id").agg(F.count("*").alias("n"), F.min("text").alias("text"), F.max("text").alias("most")).collect()
    said = ("long " * 1000).strip() + " (softly)"
    assert sorted((r["script_id"], r["n"]) for r in got) == [(k, k % 3 + 1) for k in range(1, 9)] and all(r["text"] == r["most"] == said for r in got)
    assert [tuple(r) for r in p.actions.where("script_id = 2").collect()] == [(2, 0, "Runs.")]


def test_quartiles_of_groups_over_several_partitions(spark):
    """Values are ranked over partitions in order, so no task aggregates all values of a group."""
    rng = np.random.default_rng(5)
    df = pd.DataFrame({"g": np.where(rng.random(4000) < 0.9, "x", None), "v": np.round(rng.normal(size=4000) ** 3, 2)})
    df.loc[7, "g"], df.loc[7, "v"] = "one", 4.5
    sdf = spark.createDataFrame(df.astype(object).where(df.notna(), None).values.tolist() + [["x", math.nan], ["x", None]], "g string, v double")
    b = S.box(sdf, ["g"], "v")
    assert "percentile" not in b._jdf.queryExecution().toString()
    got = {r["g"]: r for r in b.collect()}
    assert set(got) == {"x", None, "one"}
    for g, r in got.items():
        v = df.v[df.g.isna() if g is None else df.g == g].to_numpy()
        q1, median, q3 = np.quantile(v, [0.25, 0.5, 0.75])
        inside = (v >= q1 - 1.5 * (q3 - q1)) & (v <= q3 + 1.5 * (q3 - q1))
        assert np.allclose([r["q1"], r["median"], r["q3"], r["mean"], r["low"], r["high"]], [q1, median, q3, v.mean(), v[inside].min(), v[inside].max()], atol=1e-9)
        assert (r["n"], r["n_outliers"]) == (len(v), int((~inside).sum()))
