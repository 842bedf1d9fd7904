"""Model providers: what the metrics ask of models, as column expressions.

``Letters`` is a test double built of plain expressions, so that SQL can say the same; its scores tell nothing about
screenplays. ``Models`` runs given Python functions in Arrow batches, loaded once for each worker.
"""

from __future__ import annotations

import builtins
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorgnette.functions.text import numbered_items, prefix, strip, strip_tags

#: Characters that questions and emotions are judged by, and that the event extractor can take in beside its prompt.
LABEL_CHARS, EVENT_CHARS = 500, 2048 - 209 - 100


def label_of(answer: Column) -> Column:
    return F.lower(strip(answer)) == "yes"


def emotion_of(answer: Column) -> Column:
    """1, 0 or -1 for the first of positive, negative and neutral that is found; null for none."""
    a = F.lower(answer)
    return F.when(a.contains("positive"), 1).when(a.contains("negative"), -1).when(a.contains("neutral"), 0)


class Letters:
    """Embeds a text as the counts of its 26 letters; labels go by lengths."""

    def embed(self, text: Column) -> Column:
        # As an array's only element the text is cleaned once, not for each letter.
        count = lambda t: F.array(*[(F.length(t) - F.length(F.replace(t, F.lit(x), F.lit("")))).cast("double") for x in "abcdefghijklmnopqrstuvwxyz"])
        return F.get(F.transform(F.array(F.lower(strip_tags(text))), count), 0)

    def is_question(self, text: Column) -> Column:
        return label_of(F.when(F.length(prefix(text, LABEL_CHARS)) % 2 == 0, " Yes\n").otherwise("no"))

    def has_intent(self, text: Column) -> Column:
        return label_of(F.when(F.length(prefix(text, LABEL_CHARS)) % 3 != 0, "YES").otherwise("yes."))

    def emotion(self, speaker: Column, text: Column) -> Column:
        k = (F.length(speaker) + F.length(prefix(text, LABEL_CHARS))) % 4
        return emotion_of(F.when(k == 0, "Positive").when(k == 1, "negative or neutral").when(k == 2, "NEUTRAL").otherwise("unclear"))

    def events(self, text: Column) -> Column:
        return numbered_items(prefix(text, EVENT_CHARS))


class Models:
    """``load()`` gives ``embed(list[str]) -> list[list[float]]`` and ``answer(list[str]) -> list[str]``; it runs once in each worker process.

    An empty text is embedded as zeros and answered by '', and so is every text of a batch that fails.
    """

    def __init__(self, load: Callable, dimension: int, question: str, intent: str, emotion: str, events: str, batch: int = 16):
        self.load, self.dimension, self.batch, self.name = load, dimension, batch, uuid.uuid4().hex
        self.templates = {"question": question, "intent": intent, "emotion": emotion, "events": events}

    def _run(self, which: str, empty, kind: str):
        load, size, name = self.load, self.batch, self.name

        @F.pandas_udf(kind)
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            # Workers outlive tasks and serve all functions of a model, which is kept where each of them finds it.
            loaded = vars(builtins).setdefault("_loaded_models", {})
            if name not in loaded:
                loaded[name] = load()
            model = getattr(loaded[name], which)
            for s in batches:
                out = [empty] * len(s)
                full = [i for i, t in enumerate(s) if t]
                for k in range(0, len(full), size):
                    part = full[k : k + size]
                    try:
                        for i, x in zip(part, model([s.iloc[i] for i in part]), strict=True):
                            out[i] = x
                    except Exception:  # noqa: BLE001 a failed batch keeps its defaults
                        continue
                yield pd.Series(out)

        return run

    def embed(self, text: Column) -> Column:
        return self._run("embed", [0.0] * self.dimension, "array<double>")(strip_tags(text))

    def _answer(self, prompt: Column, text: Column) -> Column:
        return self._run("answer", "", "string")(F.when(F.coalesce(text, F.lit("")) != "", prompt).otherwise(""))

    def _ask(self, name: str, text: Column, speaker: Column | None = None) -> Column:
        out = F.lit(self.templates[name])
        if speaker is not None:
            out = F.replace(out, F.lit("{char}"), speaker)
        return self._answer(F.replace(out, F.lit("{text}"), text), text)

    def is_question(self, text: Column) -> Column:
        return label_of(self._ask("question", prefix(text, LABEL_CHARS)))

    def has_intent(self, text: Column) -> Column:
        return label_of(self._ask("intent", prefix(text, LABEL_CHARS), F.lit("CHARACTER")))

    def emotion(self, speaker: Column, text: Column) -> Column:
        return emotion_of(self._ask("emotion", prefix(text, LABEL_CHARS), speaker))

    def events(self, text: Column) -> Column:
        return numbered_items(self._ask("events", prefix(text, EVENT_CHARS)))


#: Rules by which a model's name chooses its provider, the first that fits: exact names or parts of the lower-cased name.
ROUTES: list[tuple[str, list[str], list[str]]] = [
    ("silicon", ["Qwen/QwQ-32B", *(f"Qwen/Qwen2.5-{k}B-Instruct" for k in (7, 32, 72)), *(f"Pro/deepseek-ai/DeepSeek-{k}" for k in ("R1", "V3"))], []),
    ("google", [], ["gemini"]),
    ("openai", [], ["gpt", "o1", "o3", "o4"]),
    ("nvidia", [f"meta/llama-4-{k}-instruct" for k in ("scout-17b-16e", "maverick-17b-128e")], []),
    ("intern", ["internlm3-8b-instruct"], []),
]


def route(model: Column, routes=ROUTES) -> Column:
    """The provider of a model; null if no rule fits, which callers report at once instead of retrying."""
    out = F.when(F.lit(False), "")
    for provider, exact, parts in routes:
        fits = model.isin(exact) if exact else F.lit(False)
        for p in parts:
            fits = fits | F.lower(model).contains(p)
        out = out.when(fits, provider)
    return out


def request_key(df: DataFrame) -> DataFrame:
    return df.withColumn("model_path", F.replace(F.col("model"), F.lit("/"), F.lit("_")))


def unanswered(requests: DataFrame, cache: DataFrame, keys: list[str]) -> DataFrame:
    """The requests without a non-empty answer in the cache."""
    return requests.join(cache.where(F.coalesce(F.col("response"), F.lit("")) != "").select(*keys).distinct(), keys, "left_anti")


def answer(requests: DataFrame, call: Callable[[str, str], str], tasks: int | None = None, attempts: int = 10, wait: float = 60.0) -> DataFrame:
    """``requests`` (model, prompt, ...) with ``response`` and ``error``: ``call(model, prompt)`` up to ``attempts`` times; then ``ERROR:`` and the reason.

    Models without a provider fail at once. ``tasks`` requests run at a time.
    """
    import time

    requests = requests.withColumn("provider", route(F.col("model")))
    if tasks:
        requests = requests.repartition(tasks)

    def run(batches):
        for pdf in batches:
            responses, errors = [], []
            for model, text, provider in zip(pdf["model"], pdf["prompt"], pdf["provider"], strict=True):
                response, error = None, None if provider else f"no provider for {model}"
                for k in range(attempts if provider else 0):
                    try:
                        response, error = call(model, text), None
                        if response:
                            break
                        error = "empty response"
                    except Exception as e:  # noqa: BLE001 any failure of a service is retried
                        error = str(e)
                    if k + 1 < attempts:
                        time.sleep(wait)
                responses.append(response or f"ERROR:{error}")
                errors.append(error)
            yield pdf.assign(response=responses, error=errors)

    schema = requests.withColumns({"response": F.lit(None).cast("string"), "error": F.lit(None).cast("string")}).schema
    return requests.mapInPandas(run, schema)
