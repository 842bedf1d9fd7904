"""Column functions against Python's own, quirks included."""

import html
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lorgnette.functions import text as T
from lorgnette.functions import vectors as V


def values(spark, rows, column, schema="x string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r["y"] for r in df.select("i", column.alias("y")).orderBy("i").collect()]


def test_strip_is_unicode(spark):
    rows = ["  a b ", "  x　", "\x1c\x1fy\x85", "", "\n\t", None, "a\nb \n"]
    assert values(spark, rows, T.strip("x")) == [None if r is None else r.strip() for r in rows]


def test_tag_cleaners_differ_on_lines(spark):
    rows = ["a<b>c</b>", "a<b\nd>c", "a < b > c <", "<>x"]
    assert values(spark, rows, T.clean_element("x")) == [re.sub("<.*?>", "", r).strip() for r in rows]
    assert values(spark, rows, T.strip_tags("x")) == [re.sub("<[^>]+>", "", r).strip() for r in rows]
    assert values(spark, [None], T.strip_tags("x")) == [""]


def test_unescape(spark):
    rows = ["&lt;scene&gt;", "&amp;amp;", "caf&eacute; &#233; &copy", None]
    assert values(spark, rows, T.html_unescape("x")) == [None if r is None else html.unescape(r) for r in rows]


def test_unwrap_takes_each_affix_once_in_order(spark):
    rows = {
        "```xml\n<script>a</script>\n```": "a",
        " <script>a</script> ": "a",
        "<script>```xml a": "```xml a",
        "```xml ```xml a": "```xml a",
        "a</script>```": "a",
        "a```</script>": "a```",
        "```XML a": "```XML a",
        "": "",
        "```": "",
    }
    assert values(spark, list(rows), T.unwrap("x")) == list(rows.values())


def test_numbered_items(spark):
    text = "1. He runs away\n\n2) no\n- She waits here\n*•3.4 ok then\none\n" + " ".join(["w"] * 25) + "\n 5. " + " ".join(["w"] * 24)
    assert values(spark, [text], T.numbered_items("x")) == [["He runs away", ") no", "She waits here", "ok then", " ".join(["w"] * 24)]]


def test_prompts(spark):
    df = spark.createDataFrame([("base", "A {summary} %s", None), ("instruction", "B", "s")], "v string, m string, s string")
    got = [r[0] for r in df.select(T.prompt("v", F.col("m"), F.col("s"))).collect()]
    assert "B" in got[1] and got[1].endswith("s") and "%s" in got[0]
    with pytest.raises(Exception, match="unknown prompt version"):
        spark.createDataFrame([("base2", "", "")], "v string, m string, s string").select(T.prompt("v", F.col("m"), F.col("s"))).collect()


def test_file_names(spark):
    rows = ["gpt-4o_base.csv", "a_b_rag.csv", "x_rag.csv.bak", "instruction.csv", "m_instruction.csv"]
    assert values(spark, rows, T.file_model("x")) == ["gpt-4o", "a_b", "", "", "m"]
    assert values(spark, rows, T.file_ablation("x")) == ["base", "rag", "", "", "instruction"]
    assert values(spark, ["meta_llama-4-scout-instruct", "meta_llama-instruct", "internlm3-8b-instruct", "o3-mini", "gpt-4o"], T.display_name("x")) == ["llama-scout", "llama", "internlm3-instruct", "o3", "gpt"]


def test_python_float(spark):
    rows = ["1", " 1.5\n", "1_0", "1_", "_1", "1.0d", "1f", "nan", "-NaN", "inf", "-Infinity", "1e5", "1e", ".5", "5.", ".", "", "x", "1__0", "0x1", None]

    def want(r):
        try:
            return float(r)
        except (ValueError, TypeError):
            return None

    for r, a in zip(rows, values(spark, rows, T.python_float("x")), strict=True):
        b = want(r)
        assert (a is None and b is None) or a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b)), (r, a, b)


def test_cosines(spark):
    rng = np.random.default_rng(0)
    rows = [([1.0, 0.0], [0.0, 0.0]), ([1.0, 2.0], [-1.0, -2.0]), ([1.0], [1.0, 2.0]), (None, [1.0]), ([], []), ([1e200, 1e200], [1e200, 1e200]), ([1e200, 0.0], [0.0, 1e200])]
    rows += [(list(map(float, rng.normal(size=5))), list(map(float, rng.normal(size=5)))) for _ in range(20)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a array<double>, b array<double>")
    got = df.select("i", V.cosine("a", "b").alias("c"), V.raw_cosine("a", "b").alias("r"), V.cosine("b", "a").alias("s")).orderBy("i").collect()
    assert [r["c"] for r in got[:7]] == [0, 0, 0, 0, 0, 1.0, 0.0] and abs(got[1]["r"] + 1) < 1e-12
    for (a, b), r in zip(rows[7:], got[7:], strict=True):
        c = np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b)
        assert abs(r["r"] - c) < 1e-12 and 0 <= r["c"] <= 1 and r["c"] == r["s"]
