"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on ordinary text, one on the text of toxic documents, from
which the words that ordinary documents have as well are left out, as toxic documents consist of them
for the most part and a dictionary of whole windows holds little else. A window of a text is
compressed against the ordinary dictionary, and against the toxic one followed by the ordinary one;
text that both know takes equally many bytes, and every toxic phrase takes fewer with the second. The
bytes saved over a document's windows go into a logistic score, calibrated on documents that neither
dictionary has seen, with the limit of best F1 placed at 0.5.

Fitting sees at most about ``docs_per_class`` labelled documents of each class, chosen by the
checksum of their id; of these, at most ``ordinary_windows`` and ``toxic_windows`` windows. Every
text is scored whole.

Nulls: a null or empty text has one empty window and scores what such a text scores; null labels and
labels of unknown documents teach nothing; of several labels of one document the highest counts, of
several texts the least. With
one class only, or none, every score is the share of toxic labels. An empty table gives an empty
result. Repeated rows score alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscore.llm.common import held_out, table
from payscore.shared import UNMEASURED, store

_LETTERS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Settings:
    """Bounds of the sample, sizes of the dictionaries, and how text is cut."""

    docs_per_class: int = 4000
    ordinary_windows: int = 60_000
    toxic_windows: int = 60_000
    ordinary_bytes: int = 131_072
    toxic_bytes: int = 6000
    #: A word stays in the toxic dictionary's text if its share of toxic documents is so many times that of ordinary ones.
    odds: float = 10.0
    least_docs: int = 4
    window: int = 20
    level: int = 12
    #: Part of the sample that is kept from the dictionaries, in percent.
    calibration: int = 35


def windows_of(text: str | None, words: int) -> list[bytes]:
    found = _LETTERS.findall(text.lower()) if text else []
    return [" ".join(found[k : k + words]).encode() for k in range(0, max(1, len(found)), words)]


def trained(samples: list[bytes], size: int) -> bytes:
    """Dictionary content for the samples; if they fit as they are, or cannot be trained on, the samples themselves."""
    whole = b" ".join(samples)
    if len(whole) <= size:
        return whole
    try:
        made = zstandard.train_dictionary(size, samples, level=3).as_bytes()
    except zstandard.ZstdError:
        return whole[-size:]
    # What a trained dictionary starts with are tables of codes; the text is at its end.
    return made[min(len(made) // 8, 1024) :]


class Sizes:
    """Compressed sizes of windows against one dictionary."""

    def __init__(self, content: bytes, level: int):
        parameters = zstandard.ZstdCompressionParameters.from_level(
            level, source_size=100, dict_size=len(content), window_log=19, min_match=3, write_content_size=0, write_checksum=0, write_dict_id=0
        )
        if len(content) < 8:
            self.compressor = zstandard.ZstdCompressor(compression_params=parameters)
            return
        words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(compression_params=parameters)
        self.compressor = zstandard.ZstdCompressor(dict_data=words, compression_params=parameters)

    def __call__(self, window: bytes) -> int:
        return len(self.compressor.compress(window))


def features(text: str | None, ordinary: Sizes, toxic: Sizes, words: int) -> list[float]:
    """What a text's windows save: on average, at most, the two best, and the parts that save much."""
    saved = np.array([ordinary(w) - toxic(w) for w in windows_of(text, words)], float)
    best = np.sort(saved)[::-1]
    n = max(len(saved), 5)
    return [saved.sum() / n, best[0], best[:2].sum(), (saved >= 3).sum() / n, (saved >= 5).sum() / n, np.log(len(saved))]


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    means: np.ndarray
    scales: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.means) / self.scales) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Newton steps of ridge-penalised logistic regression."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    penalty = np.diag([ridge] * x.shape[1] + [1e-6])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + penalty, a.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Train both dictionaries and the score on labelled documents; leave held-out ones away before."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.where(F.col("toxic").isin(0, 1)).groupBy("toxic").count().collect()}
    total = sum(sizes.values())
    share = sizes.get(1, 0) / total if total else 0.0
    part = F.when(F.col("toxic") == 1, min(1.0, settings.docs_per_class / max(sizes.get(1, 1), 1)))
    part = part.when(F.col("toxic") == 0, min(1.0, settings.docs_per_class / max(sizes.get(0, 1), 1)))
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("toxicity")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # The sample is bounded, so its ids can be broadcast.
    some = F.broadcast(known.where(place < part))
    chosen = docs.select("doc_id", "text").join(some, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))
    aside = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("aside")), F.lit(100)) < settings.calibration
    chosen = store(chosen.withColumn("aside", aside), UNMEASURED).df
    ordinary, toxic = _contents(chosen.where("NOT aside"), settings)
    if share in (0.0, 1.0):
        return Model(ordinary, toxic, np.zeros(6), np.ones(6), np.zeros(6), float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    rows = _measured(chosen.where("aside").select(F.col("toxic").cast("string"), "text"), ordinary, toxic, settings).collect()
    y = np.array([r[0] == "1" for r in rows], float)
    x = np.array([r[1] for r in rows], float).reshape(len(rows), 6)
    if not len(y) or y.min() == y.max():
        return Model(ordinary, toxic, np.zeros(6), np.ones(6), np.zeros(6), float(np.log(share / (1 - share))))
    means, scales = x.mean(axis=0), x.std(axis=0) + 1e-9
    weights, bias = _logistic((x - means) / scales, y)
    # Classes are sampled at different rates; the limit is chosen for the true shares.
    bias -= _weighted_limit(((x - means) / scales) @ weights + bias, y, share)
    return Model(ordinary, toxic, means, scales, weights, bias)


def _weighted_limit(z: np.ndarray, y: np.ndarray, share: float) -> float:
    """The limit of best F1 if a part ``share`` of all documents is toxic."""
    order = np.argsort(-z, kind="stable")
    z, y = z[order], y[order]
    w = np.where(y == 1, share / max(y.sum(), 1), (1 - share) / max((1 - y).sum(), 1))
    f1 = 2 * np.cumsum(w * y) / (np.cumsum(w) + share)
    f1[:-1][z[:-1] == z[1:]] = 0
    k = int(f1.argmax())
    return float((z[k] + z[min(k + 1, len(z) - 1)]) / 2)


def _contents(sample: DataFrame, settings: Settings) -> tuple[bytes, bytes]:
    """What both dictionaries hold."""
    words = F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+"), lambda w: F.char_length(w) >= 1)
    rows = sample.select("doc_id", "toxic", words.alias("words"))
    docs = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_toxic, n_plain = docs.get(1, 0), docs.get(0, 0)
    each = rows.select("toxic", F.explode(F.array_distinct("words")).alias("word"))
    counts = each.groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("p"))
    odds = (F.col("t") / max(n_toxic, 1)) / ((F.col("p") + 0.5) / max(n_plain, 1))
    special = counts.where((F.col("t") >= settings.least_docs) & (odds >= settings.odds)).select("word")
    # The texts of toxic documents without the words that ordinary ones have as well.
    placed = rows.where("toxic = 1").select("doc_id", F.posexplode("words").alias("at", "word")).join(special, "word", "left_semi")
    left = placed.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).getField("word").alias("words"))
    toxic = [r["w"].encode() for r in _picked(left, settings, settings.toxic_windows, distinct=False)]
    plain = [r["w"].encode() for r in _picked(rows.where("toxic = 0"), settings, settings.ordinary_windows, distinct=True)]
    return trained(plain, settings.ordinary_bytes), trained(toxic, settings.toxic_bytes)


def _picked(rows: DataFrame, settings: Settings, most: int, distinct: bool) -> list:
    """At most ``most`` windows of the documents' words, chosen by their hash; equal ones count once if ``distinct``."""
    size = settings.window
    places = F.sequence(F.lit(1), F.greatest(F.size("words"), F.lit(1)), F.lit(size))
    windows = F.transform(places, lambda i: F.array_join(F.slice("words", i, size), " "))
    cut = rows.select("doc_id", F.explode(windows).alias("w")).where("w != ''")
    if distinct:
        cut = cut.select("w").distinct()
    by = [F.xxhash64("w"), "w"] if distinct else [F.xxhash64("w", F.col("doc_id").cast("string")), "w"]
    return cut.orderBy(*by).limit(most).select("w").collect()


def _measured(rows: DataFrame, ordinary: bytes, toxic: bytes, settings: Settings) -> DataFrame:
    """The first column of the rows, and the features of their texts (the second)."""
    given = rows.sparkSession.sparkContext.broadcast((ordinary, toxic))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, special = given.value
        first, second = Sizes(plain, settings.level), Sizes(special + plain, settings.level)
        for batch in batches:
            x = [features(t.as_py(), first, second, settings.window) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], ["key", "x"])

    return rows.mapInArrow(run, f"key {rows.schema[0].dataType.simpleString()}, x array<double>")


def score(docs: DataFrame, model: Model, settings: Settings = Settings()) -> DataFrame:
    """doc_id and score of each row."""
    rows = _measured(docs.select("doc_id", "text"), model.ordinary, model.toxic, settings)
    z = F.lit(float(model.bias))
    for k, (m, s, w) in enumerate(zip(model.means, model.scales, model.weights, strict=True)):
        z = z + (F.get("x", F.lit(k)) - float(m)) / float(s) * float(w)
    return rows.select(F.col("key").alias("doc_id"), (1 / (1 + F.exp(-z))).alias("score"))


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learn = ~held_out(F.col("doc_id"))
    model = fit(docs.where(learn), table(spark, sf_dir, "labels").where(learn))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
