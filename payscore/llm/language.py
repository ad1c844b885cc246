"""Language identification, word first.

A word that the model knows adds the logarithm of its frequency in each language. An unseen word
backs off to its character n-grams, longest first: the first length of which any n-gram is known
decides, by the mean over those n-grams. The language with the largest sum wins, and the score is
its share after a softmax.

The model is fitted on a bounded sample: at most about ``docs_per_lang`` documents of each language,
chosen by the checksum of their id, of which the ``max_words`` commonest words and the ``max_grams``
commonest n-grams of each length are kept, and with many languages only so many that the model has at
most ``max_cells`` numbers for words and as many for the n-grams of all lengths. Of equally common
texts the first by code point are kept. Prediction covers the whole of every text.

Nulls: a null text, or one without a letter (Unicode category L), is ``und`` with score 0. Documents
with a null language teach nothing. With nothing learned every document is ``und``. Of languages with
equal sums the first by code point wins. An empty table gives an empty result. Repeated rows are
predicted alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscore.llm.common import held_out, table

UNKNOWN = "und"
_WORDS = re.compile(r"[^\W\d_]+")
#: More languages than there are on earth are an error in the table, and are refused.
MOST_LANGS = 10_000
#: Unseen words whose scores one worker remembers.
_REMEMBERED = 200_000


@dataclass(frozen=True)
class Bounds:
    """What the model may hold."""

    docs_per_lang: int = 2000
    max_words: int = 100_000
    max_grams: int = 50_000
    longest: int = 5
    min_count: int = 2
    max_cells: int = 8_000_000


@dataclass
class Model:
    """Log frequencies by language of words, and of n-grams of each length."""

    langs: list[str]
    words: dict[str, int]
    word_logs: np.ndarray
    grams: list[dict[str, int]]
    gram_logs: list[np.ndarray]

    def backed_off(self, words: list[str]) -> np.ndarray:
        """Scores of unseen words, one row each."""
        out = np.zeros((len(words), len(self.langs)))
        left = [(i, f"^{w}$") for i, w in enumerate(words)]
        for n in range(len(self.grams), 0, -1):
            known, rest, ids, starts, rows = self.grams[n - 1].get, [], [], [], []
            for i, w in left:
                at = len(ids)
                ids += [j for k in range(len(w) - n + 1) if (j := known(w[k : k + n])) is not None]
                if len(ids) > at:
                    starts.append(at)
                    rows.append(i)
                else:
                    rest.append((i, w))
            if rows:
                sums = np.add.reduceat(self.gram_logs[n - 1][ids], starts, axis=0)
                out[rows] = sums / np.diff([*starts, len(ids)])[:, None]
            left = rest
        return out


def _log_table(rows: list, langs: list[str]) -> tuple[dict[str, int], np.ndarray]:
    """Rows (text, language, count) -> places and smoothed log frequencies."""
    places: dict[str, int] = {}
    for text, _, _ in rows:
        places.setdefault(text, len(places))
    counts = np.zeros((len(places), len(langs)))
    lang_at = {x: i for i, x in enumerate(langs)}
    for text, lang, n in rows:
        counts[places[text], lang_at[lang]] += n
    return places, np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * max(len(places), 1)))


def fit(docs: DataFrame, bounds: Bounds = Bounds()) -> Model:
    """Learn from the documents given; leave held-out ones away before."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = known.groupBy("lang").count().limit(MOST_LANGS + 1).collect()
    langs = sorted(r["lang"] for r in sizes)
    if len(langs) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} languages")
    if not langs:
        return Model([], {}, np.zeros((0, 0)), [], [])
    max_words = min(bounds.max_words, bounds.max_cells // len(langs))
    max_grams = min(bounds.max_grams, bounds.max_cells // (len(langs) * bounds.longest))
    part = {r["lang"]: min(1.0, bounds.docs_per_lang / r["count"]) for r in sizes}
    share = F.element_at(F.create_map(*[x for k, v in part.items() for x in (F.lit(k), F.lit(v))]), F.col("lang"))
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("language")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = known.where(place < share)
    words = some.select("lang", F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("t")).where("t != ''")
    counts = words.groupBy("lang", "t").agg(F.count(F.lit(1)).alias("n")).persist()
    try:
        word_rows = _commonest(counts, max_words, bounds.min_count)
        padded = counts.select("lang", "n", F.concat(F.lit("^"), "t", F.lit("$")).alias("p"))
        grams = []
        for n in range(1, bounds.longest + 1):
            at = F.sequence(F.lit(1), F.char_length("p") - (n - 1))
            of = padded.where(F.char_length("p") >= n).select("lang", "n", F.explode(F.transform(at, lambda i: F.substring("p", i, F.lit(n)))).alias("t"))
            grams.append(_commonest(of.groupBy("lang", "t").agg(F.sum("n").alias("n")), max_grams, bounds.min_count))
    finally:
        counts.unpersist()
    places, logs = _log_table(word_rows, langs)
    made = [_log_table(rows, langs) for rows in grams]
    return Model(langs, places, logs, [p for p, _ in made], [x for _, x in made])


def _commonest(counts: DataFrame, limit: int, least: int) -> list:
    """The rows (t, lang, n) of the commonest texts over all languages."""
    total = counts.groupBy("t").agg(F.sum("n").alias("total")).where(F.col("total") >= least)
    top = total.orderBy(F.desc("total"), "t").limit(limit).select("t")
    return [(r["t"], r["lang"], r["n"]) for r in counts.join(top, "t").select("t", "lang", "n").collect()]


def words_in(text: str) -> list[str]:
    """The runs of letters of a text in small letters. Signs such as ½, ² and ① are no letters."""
    words = _WORDS.findall(text.lower())
    if "".join(words).isalpha():
        return words
    return [w for x in words for w in "".join(c if c.isalpha() else " " for c in x).split()]


def score_texts(model: Model, texts: Iterator[str | None], remembered: dict) -> tuple[list[str], list[float]]:
    """The language and its share for each text. ``remembered`` holds scores of unseen words."""
    langs, shares = [], []
    for text in texts:
        words = words_in(text) if text else []
        if not words or not model.langs:
            langs.append(UNKNOWN)
            shares.append(0.0)
            continue
        get = model.words.get
        ids = [get(w, -1) for w in words]
        at = np.array(ids)
        total = model.word_logs[at[at >= 0]].sum(axis=0)
        unseen = [w for w, i in zip(words, ids, strict=True) if i < 0]
        if unseen:
            new = [w for w in dict.fromkeys(unseen) if w not in remembered]
            if new:
                if len(remembered) + len(new) > _REMEMBERED:
                    remembered.clear()
                    new = list(dict.fromkeys(unseen))
                remembered.update(zip(new, model.backed_off(new), strict=True))
            total = total + np.sum([remembered[w] for w in unseen], axis=0)
        best = int(np.argmax(total))
        langs.append(model.langs[best])
        shares.append(float(1 / np.exp(total - total[best]).sum()))
    return langs, shares


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Adds nothing but the prediction: doc_id, lang_pred, score, for each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.words, model.word_logs, model.grams, model.gram_logs))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered: dict = {}
        known = Model(*shared.value)
        for batch in batches:
            langs, shares = score_texts(known, (x.as_py() for x in batch.column(1)), remembered)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(shares, pa.float64())], ["doc_id", "lang_pred", "score"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double")


def op2_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    return identify(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
