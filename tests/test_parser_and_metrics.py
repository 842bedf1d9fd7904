"""The parsers against state machines, the metrics against loops, and quirks one by one."""

import html
import random
import re

import numpy as np
import pytest

from lorgnette.operators import metrics as M
from lorgnette.operators import parser, providers
from lorgnette.operators.parser import KINDS, PLAIN_LINE, PLAIN_SPLIT

CLEAN = re.compile("<.*?>")


def machine(text):
    """A tagged script by a walk over its elements."""
    out = {"scenes": [], "dialogues": [], "actions": []}
    text = html.unescape((text or "").strip())
    found = re.findall("<scene>(.*?)</scene>", text, re.S | re.I)
    if not found:
        whole = CLEAN.sub("", text).strip()
        if whole:
            out["scenes"], out["actions"] = [whole], [whole]
        return out
    for raw in found:
        tidy = lambda tag, raw=raw: [y for y in (CLEAN.sub("", x).strip() for x in re.findall(f"<{tag}>(.*?)</{tag}>", raw, re.S | re.I)) if y]
        heads = tidy("stage_direction")
        scene = "\\n".join(heads + tidy("scene_description"))
        if scene:
            out["scenes"].append(scene)
        acts, who = list(heads), None
        for m in re.finditer(rf"<({'|'.join(KINDS)})>(.*?)</\1>", raw, re.S | re.I):
            kind, body = m[1].lower(), CLEAN.sub("", m[2]).strip()
            if not body:
                continue
            if kind == "character":
                who = body.upper()
            elif kind == "dialogue":
                if who:
                    out["dialogues"].append([who, body])
            elif kind == "parenthetical":
                if who and out["dialogues"] and out["dialogues"][-1][0] == who:
                    out["dialogues"][-1][1] += f" ({body})"
                else:
                    acts.append(f"({body})")
            else:
                acts.append(body)
        out["actions"] += acts
    out["actions"] = list(dict.fromkeys(out["actions"]))
    return out


def plain_machine(text):
    line = re.compile(PLAIN_LINE.replace("(?md)", ""), re.M)
    out = {"scenes": [s.strip() for s in re.split(PLAIN_SPLIT.replace("(?iU)", ""), text or "", flags=re.I) if s.strip()], "dialogues": [], "actions": []}
    for s in out["scenes"]:
        out["dialogues"] += [[m[1].strip(), m[2].strip()] for m in line.finditer(s)]
        rest = line.sub("", s).strip()
        if rest:
            out["actions"].append(rest)
    return out


def collected(frames):
    out = {}
    for name, df in frames.items():
        for r in sorted(df.collect(), key=lambda r: (r["script_id"], r["pos"])):
            out.setdefault(r["script_id"], {"scenes": [], "dialogues": [], "actions": []})[name].append([r["character"], r["text"]] if name == "dialogues" else r["text"])
    return out


def random_script(rnd):
    def piece(depth=0):
        kind = rnd.choice([*KINDS, "b", "character", "dialogue"])
        body = rnd.choice(["Ann", "bob", " x ", "", "Go\non", "a &lt;i&gt; b", "<u>u</u>", "<i\nj>k"])
        if depth < 1 and rnd.random() < 0.15:
            body += piece(1)
        open_, close = (kind.upper(), kind) if rnd.random() < 0.2 else (kind, kind)
        attr = ' class="z"' if rnd.random() < 0.05 else ""
        return f"<{open_}{attr}>{body}</{close}>" + rnd.choice(["", "\n", " t "])

    body = "".join(f"<scene>{''.join(piece() for _ in range(rnd.randrange(9)))}</scene>" if rnd.random() < 0.9 else piece() for _ in range(rnd.randrange(5)))
    return rnd.choice(["{}", "<script>{}</script>", " {} "]).format(body)


FIXED = [
    None, "", "   ", "plain words", "<p>only</p> <b>tags</b>", "&lt;scene&gt;&lt;action&gt;A&lt;/action&gt;&lt;/scene&gt;", "<scene></scene>", "<scene a='1'><action>x</action></scene>",
    "<scene><dialogue>orphan</dialogue><parenthetical>p</parenthetical></scene>", "<scene><character>a</character><dialogue>d</dialogue></scene><scene><character>A</character><parenthetical>late</parenthetical></scene>",
    "<scene><stage_direction>S</stage_direction><action>S</action><action>T</action><action>S</action></scene>",
]


def test_tagged_parser_matches_the_machine(spark):
    rnd = random.Random(3)
    texts = FIXED + [random_script(rnd) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "script_id bigint, script_segment string")
    d, s, a = parser.parse_tagged(df)
    got = collected({"dialogues": d, "scenes": s, "actions": a})
    for i, t in enumerate(texts):
        assert got.get(i, {"scenes": [], "dialogues": [], "actions": []}) == machine(t), t


def test_plain_parser_and_fallback(spark):
    texts = [
        "INT. HOUSE\n\nANN: Hello there.\nShe sits.\nBOB. Well\n \t\nfade out: THE MAN runs", "ANN: a\r\nBOB: b", "one ANN: x", "the point. of context. is lost", "NO1_A-B  : ok\nX: y", None, "", "\n\n",
        "A. b\nAB: c: d\nab: no",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "script_id bigint, script_segment string")
    d, s, a = parser.parse_plain(df)
    got = collected({"dialogues": d, "scenes": s, "actions": a})
    for i, t in enumerate(texts):
        assert got.get(i, {"scenes": [], "dialogues": [], "actions": []}) == plain_machine(t), t


def test_parse_chooses_and_flags(spark):
    texts = {0: "text without scenes", 1: "<scene><action>A</action></scene>ANN: hi", 2: None, 3: "", 4: "<scene><character>a</character><dialogue>b</dialogue></scene>", 5: "<p></p>"}
    p = parser.parse(spark.createDataFrame(list(texts.items()), "script_id bigint, script_segment string"))
    flags = {r["script_id"]: (r["parsed"], r["plain"]) for r in p.scripts.collect()}
    # A scene with nothing but actions has neither scene text nor lines, so the plain parser reads the raw text.
    assert flags == {0: (1, False), 1: (1, True), 2: (0, False), 3: (0, False), 4: (1, False), 5: (1, True)}
    scores = {r["script_id"]: r for r in M.score(p).collect()}
    assert len(scores) == 6 and all(scores[i][m] == 0.0 for i in (2, 3) for m in M.METRICS)


class Fixed(providers.Letters):
    pass


def letters(t):
    t = re.sub("<[^>]+>", "", t).lower()
    return np.array([float(t.count(x)) for x in "abcdefghijklmnopqrstuvwxyz"])


def cos(a, b, clamp=True):
    if not a.any() or not b.any():
        return 0.0
    c = float(a @ b / np.linalg.norm(a) / np.linalg.norm(b))
    return min(1.0, max(0.0, c)) if clamp else c


def mean(x):
    return float(np.mean(x)) if len(x) else 0.0


def by_loops(dialogues, scenes, actions):
    out = dict.fromkeys(M.METRICS, 0.0)
    full = [(c, t) for c, t in dialogues if t]
    v = [letters(t) for _, t in full]
    near = lambda v: mean([cos(a, b) for a, b in zip(v, v[1:])])  # noqa: B905, E731
    q = [len(t[:500]) % 2 == 0 for _, t in full]
    out["dc1_adjacent_similarity"] = near(v)
    out["dc2_qa_relevance"] = mean([cos(v[i], v[i + 1]) for i in range(len(v) - 1) if q[i] and not q[i + 1]])
    spread = lambda v: 1 - mean([1 - cos(x, np.mean(v, axis=0), False) for x in v])
    live = [x for x in v if x.any()]
    if len(v) >= 2 and len(live) >= 2:
        out["dc3_topic_concentration"] = max(0.0, spread(live))
    who, calm, alike = {}, [], []
    for c, t in full:
        who.setdefault(c, []).append(t)
    for c, ts in who.items():
        e = [{0: 1, 1: -1, 2: 0}.get((len(c) + len(t[:500])) % 4) for t in ts[:20]] if len(ts) >= 2 else []
        e = [x for x in e if x is not None]
        if len(e) >= 2:
            calm.append(min(1.0, max(0.0, 1 - np.abs(np.diff(e)).mean() / 2)))
        x = [y for y in map(letters, ts) if y.any()]
        if len(ts) >= 3 and len(x) >= 2:
            alike.append(min(1.0, max(0.0, spread(x))))
    out["cc1_emotional_stability"], out["cc2_linguistic_consistency"] = mean(calm), mean(alike)
    wants = [letters(t) for _, t in dialogues[:30] if t and len(t[:500]) % 3 != 0]
    acts = [letters(a) for a in actions if a]
    best = [max([cos(w, a) for a in acts], default=0.0) for w in wants]
    out["cc3_action_intention_alignment"] = mean([b for b in best if b > 0])
    out["pr1_scene_similarity"] = near([letters(s) for s in scenes if s])
    text = "\n---\n".join([s for s in scenes if s] or [a for a in actions if a])[: providers.EVENT_CHARS]
    events = [re.sub(r"^\s*[\d.\-*•]+\s*", "", x.strip()) for x in text.strip().split("\n")]
    ev = [letters(x) for x in events if 2 <= len(x.split()) <= 24]
    out["pr2_event_coherence"] = mean([cos(a, b, False) for a, b in zip(ev, ev[1:])])  # noqa: B905
    return out


def test_metrics_match_loops(spark):
    rnd = random.Random(5)
    words = ["sun", "rain", "123", "<b>", "door", "!!!", "open the gate\nand run", "stop"]
    say = lambda: " ".join(rnd.choice(words) for _ in range(rnd.randrange(0, 6)))
    data = {i: ([(rnd.choice("AB"), say()) for _ in range(rnd.randrange(0, 50))], [say() for _ in range(rnd.randrange(0, 5))], [say() for _ in range(rnd.randrange(0, 6))]) for i in range(40)}
    rows = [(i, "d", p, c, t) for i, x in data.items() for p, (c, t) in enumerate(x[0])] + [(i, k, p, None, t) for i, x in data.items() for k, y in (("s", x[1]), ("a", x[2])) for p, t in enumerate(y)]
    long = spark.createDataFrame(rows, "script_id bigint, kind string, pos int, character string, text string")
    scripts = spark.createDataFrame([(i, 1) for i in data], "script_id bigint, parsed int")
    got = {r["script_id"]: r for r in M.score_texts(scripts, long, Fixed()).collect()}
    d, s, a = (long.where(f"kind = '{k}'") for k in "dsa")
    alone = [M.dc1(d), M.dc2(d), M.dc3(d), M.cc1(d), M.cc2(d), M.cc3(d, a), M.pr1(s), M.pr2(s, a)]
    for name, m in zip(M.METRICS, alone, strict=True):
        by = {r["script_id"]: r["score"] for r in m.collect()}
        assert all(abs(by.get(i, 0.0) - got[i][name]) < 1e-9 for i in data), name
    for i, x in data.items():
        for m, want in by_loops(*x).items():
            assert abs(got[i][m] - want) < 1e-9, (i, m)


def test_models_provider_batches_and_survives_failures(spark):
    class Fake:
        def embed(self, texts):
            if any("bad" in t for t in texts):
                raise RuntimeError("no")
            return [[float(len(t)), 1.0] for t in texts]

        def answer(self, prompts):
            return ["Yes" if "?" in p else "negative" for p in prompts]

    m = providers.Models(Fake, 2, "Q: {text}", "I: {char} {text}", "E: {char}: {text}", "{text}", batch=1)
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(0, "ab"), (1, ""), (2, "bad"), (3, "why?"), (4, None)], "i int, t string")
    got = {r["i"]: r for r in df.select("i", m.embed(F.col("t")).alias("v"), m.is_question(F.col("t")).alias("q"), m.emotion(F.lit("{x}"), F.col("t")).alias("e")).collect()}
    assert got[0]["v"] == [2.0, 1.0] and got[1]["v"] == got[2]["v"] == got[4]["v"] == [0.0, 0.0]
    assert [got[i]["q"] for i in range(4)] == [False, False, False, True] and got[0]["e"] == -1 and got[1]["e"] is None


def test_answers_are_retried_cached_and_routed(spark, tmp_path):
    from lorgnette.sources import sinks

    def call(model, prompt):
        if prompt == "p2":
            raise ValueError("down")
        return f"{model}:{prompt}"

    asked = spark.createDataFrame([("a", "gpt-x", "p1"), ("b", "gpt-x", "p2"), ("c", "nobody", "p3")], "imdb_id string, model string, prompt string")
    got = {r["imdb_id"]: r for r in providers.answer(asked, call, 2, 2, 0.0).collect()}
    assert got["a"]["response"] == "gpt-x:p1" and got["b"]["response"] == "ERROR:down" and got["c"]["error"] == "no provider for nobody"
    sinks.add_to_cache(providers.answer(asked, call, 2, 2, 0.0), str(tmp_path / "cache"))
    left = providers.unanswered(asked, spark.read.parquet(str(tmp_path / "cache")), ["imdb_id", "model"])
    assert {r["imdb_id"] for r in left.collect()} == {"b", "c"}


@pytest.mark.parametrize("model,want", [("my/Gemini-1", "google"), ("o1-mini", "openai"), ("internlm3-8b-instruct", "intern"), ("Qwen/QwQ-32B", "silicon"), ("zzz", None)])
def test_routes(spark, model, want):
    from pyspark.sql import functions as F

    assert spark.range(1).select(providers.route(F.lit(model)).alias("p")).first()["p"] == want
