"""Language identification: averaged hashed subword embeddings and a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.codepoints import letters_of, subword_hashes

UNDETERMINED = "und"


@dataclass(frozen=True)
class LanguageSettings:
    #: Documents that are learned from, on average, over all languages; no more than twice that.
    sample: int = 2000
    sizes: tuple[int, ...] = (1, 2, 3, 4)
    buckets: int = 1 << 13
    width: int = 16
    #: Steps of gradient descent, whatever the size of the sample.
    steps: int = 2000
    batch: int = 32
    rate: float = 0.5
    #: A score is rejected if documents that score so had less than this accuracy.
    accuracy: float = 0.95
    seed: int = 7


def held_out(doc_id: Column, folds: int = 5, fold: int = 0) -> Column:
    """Whether crc32 of the id as text falls in the fold. A null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(True))


def _counts(text: str, settings: LanguageSettings) -> np.ndarray:
    hashes = subword_hashes(letters_of(text), settings.sizes)
    return (hashes & np.uint64(settings.buckets - 1)).astype(np.int64)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    #: Embedding times output weights: a row of logits per bucket.
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    #: Least score that is not rejected.
    least_score: float
    settings: LanguageSettings

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        buckets = _counts(text, self.settings) if text else np.array([], np.int64)
        if not len(buckets) or not self.languages:
            return UNDETERMINED, 0.0, True
        share = np.bincount(buckets, minlength=self.settings.buckets) / len(buckets)
        p = _softmax(((share @ self.table) + self.bias)[None] / self.temperature)[0]
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(p[best] < self.least_score)


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _sampled(docs: DataFrame, settings: LanguageSettings) -> DataFrame:
    """``lang, buckets, counts``: as many documents of each language, chosen by hash."""
    rows = docs.filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = rows.groupBy("lang").count().collect()  # a row per language
    if not sizes:
        return docs.sparkSession.createDataFrame([], "lang string, buckets array<int>, counts array<int>")
    each = settings.sample / len(sizes)
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, each / r["count"]))])
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(settings.seed)), F.lit(1 << 30)) / float(1 << 30)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [np.unique(_counts(t, settings), return_counts=True) for t in batch["text"]]
            yield pd.DataFrame({"lang": batch["lang"], "buckets": [f[0].astype(np.int32) for f in found],
                                "counts": [f[1].astype(np.int32) for f in found]})

    return (
        rows.filter("text IS NOT NULL").filter(drawn < share[F.col("lang")])
        .select("lang", "text").limit(2 * settings.sample)
        .mapInPandas(features, "lang string, buckets array<int>, counts array<int>")
    )


def train(docs: DataFrame, settings: LanguageSettings = LanguageSettings()) -> LanguageModel:
    """A model of the non-null ``lang`` values of documents that are not held out.

    It learns from a sample bounded by ``settings.sample``, whole texts, by stochastic gradient
    descent; a fifth of the sample sets temperature and rejection. No document to learn from
    gives a model that knows no language.
    """
    rows = _sampled(docs, settings).toPandas()
    rows = rows[rows["counts"].map(len) > 0]
    place = sorted(range(len(rows)), key=lambda i: (rows["lang"].iat[i], np.concatenate(
        [rows["buckets"].iat[i], rows["counts"].iat[i]]).astype(np.int64).tobytes()))
    rows = rows.iloc[place]  # the order in which rows arrive changes nothing
    languages = tuple(sorted(rows["lang"].unique()))
    n, buckets = len(rows), settings.buckets
    if not n:
        return LanguageModel((), np.zeros((buckets, 0)), np.zeros(0), 1.0, 1.0, settings)
    x = np.zeros((n, buckets), np.float32)
    for i, (at, count) in enumerate(zip(rows["buckets"], rows["counts"], strict=True)):
        x[i, at] = count / np.sum(count)
    y = np.searchsorted(languages, rows["lang"].to_numpy(str))
    rng = np.random.default_rng(settings.seed)
    order = rng.permutation(n)
    check, learn = (order[:n // 5], order[n // 5:]) if n >= 10 else (order, order)
    embed = rng.normal(0, 0.1, (buckets, settings.width)).astype(np.float32)
    out = np.zeros((settings.width, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    # features are shares: the embedding's steps are scaled up by their usual size
    scale = np.float32(1 / max(1e-6, float((x[learn] ** 2).sum(axis=1).mean())))
    for step in range(settings.steps):
        rate = settings.rate * (1 - step / settings.steps)
        part = rng.choice(learn, min(settings.batch, len(learn)), replace=False)
        shares = x[part]
        hidden = shares @ embed
        error = _softmax(hidden @ out + bias)
        error[np.arange(len(part)), y[part]] -= 1
        error /= len(part)
        back = error @ out.T
        out -= rate * hidden.T @ error
        bias -= rate * error.sum(axis=0)
        embed -= np.float32(rate * min(scale, 50.0)) * (shares.T @ back)
    table = (embed @ out).astype(np.float64)
    logits = x[check] @ table + bias
    temperature = min(np.geomspace(0.5, 20, 41), key=lambda t: -np.log(
        _softmax(logits / t)[np.arange(len(check)), y[check]] + 1e-12).mean())
    p = _softmax(logits / temperature)
    right, score = p.argmax(axis=1) == y[check], p.max(axis=1)
    # scores from the lowest up: the first from which on accuracy holds
    steps = np.sort(score)
    least = next((t for t in steps if right[score >= t].mean() >= settings.accuracy), 1.0)
    return LanguageModel(languages, table, bias.astype(np.float64), float(temperature),
                         float(min(least, steps[0] if right.all() else least)), settings)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Per document ``doc_id, held_out, lang_pred, score, rejected``; repeated rows stay.

    Null texts and texts without a letter are ``und`` with score 0. ``score`` is the calibrated
    probability of ``lang_pred``; ``rejected`` marks scores too low to be relied on. The text
    alone decides.
    """
    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [model.predict(t) for t in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "held_out": batch["held_out"],
                "lang_pred": [f[0] for f in found], "score": [f[1] for f in found],
                "rejected": [f[2] for f in found]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")).mapInPandas(
        predict, f"doc_id {kind}, held_out boolean, lang_pred string, score double, rejected boolean")
