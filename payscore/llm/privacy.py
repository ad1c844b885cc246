"""Personal data: fixed patterns, and terms that give away what the patterns found.

The patterns find protected entities (addresses, numbers). A term that stands near an entity again
and again, and hardly anywhere else, tells who it is even when the entity itself is masked. How much
it tells is the pointwise mutual information of term and entity, as a share of the entity's own
information: ``1 - log(df(t) / n(e, t)) / log(N / n(e))`` with counts over all documents. 1 means
the term identifies the entity; 0 means it tells nothing. Terms from ``generalise_from`` on are
replaced by their class, from ``remove_from`` on they are removed, in every document.

Evidence for a pair is the number of different texts and surroundings it was seen in, so that equal
copies of one document say no more than the document itself, and a line that many documents end with
counts for each of them.

Nulls: a null text is empty and has no spans. A null id is an id like any other, and rows with equal
ids share the terms found in either. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscore.llm.common import table, with_row
from payscore.shared import Stored, lookup, store

KINDS = ["email", "ip", "card", "phone", "term"]

# What the kinds look like. Runs are possessive and start where a run starts, which
# finds the same matches in linear time. A card is written with its number of digits.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


@dataclass(frozen=True)
class Disclosure:
    """When a term gives too much away. ``reach``: words on either side, in the entity's line."""

    generalise_from: float = 0.75
    remove_from: float = 0.90
    min_contexts: int = 3
    reach: int = 8


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    digits = _digits(match)
    n = F.char_length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _holds(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.rlike(match, F.lit(rf"^{_PART}(?:\.{_PART}){{3}}$"))
    if kind == "card":
        return _luhn(match)
    if kind == "phone":
        return F.char_length(_digits(match)).between(9, 15)
    return F.lit(True)


_SPAN = "struct<start:int,kind:int,end:int,value:string>"


def _located(text: Column, pattern: Column, kind: int) -> Column:
    """All matches with their places, which follow from the pieces between them."""
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    pieces = F.split(text, pattern, -1)
    both = F.arrays_zip(F.slice(pieces, F.lit(1), F.size(matches)).alias("gap"), matches.alias("value"))
    none = F.array().cast(f"array<{_SPAN}>")

    def step(a: Column, x: Column) -> Column:
        start = a["at"] + F.char_length(x["gap"])
        end = start + F.char_length(x["value"])
        one = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(a["spans"], F.array(one)).alias("spans"))

    found = F.aggregate(both, F.struct(F.lit(0).alias("at"), none.alias("spans")), step)["spans"]
    return F.when(F.rlike(text, pattern), found).otherwise(none)


def with_spans(df: DataFrame) -> DataFrame:
    """Adds ``_base``, the spans of the fixed kinds by start and kind, to rows with ``_text``."""
    kinds = list(PATTERNS)
    for k, kind in enumerate(kinds):
        spans = _located(F.col("_text"), F.lit(PATTERNS[kind]), k)
        df = df.withColumn(f"_{kind}", spans if kind == "email" else F.filter(spans, lambda s: _holds(kind, s["value"])))
    return df.withColumn("_base", F.sort_array(F.concat(*[f"_{k}" for k in kinds]))).drop(*[f"_{k}" for k in kinds])


def _terms(text: Column) -> Column:
    """Words of three letters or more, in small letters."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: F.char_length(w) >= 3)


def _near(rows: DataFrame, rule: Disclosure) -> DataFrame:
    """(id, entity, context, term) for the terms around each entity, in its line."""
    chars = 24 * rule.reach
    seen = rows.withColumn("_whole", F.xxhash64("_text")).withColumn("s", F.explode("_base"))
    start, end = F.col("s.start"), F.col("s.end")
    from_ = F.greatest(start - chars, F.lit(0))
    left_side = F.substring(F.col("_text"), from_ + 1, start - from_)
    right_side = F.substring(F.col("_text"), end + 1, F.lit(chars))
    # A word is broken only if the limit falls inside it, in the entity's line.
    broken_left = F.rlike(F.substring(F.col("_text"), from_, F.lit(1)), F.lit(r"\p{L}")) & (from_ > 0) & ~F.contains(left_side, F.lit("\n"))
    broken_right = F.rlike(F.substring(F.col("_text"), end + chars + 1, F.lit(1)), F.lit(r"\p{L}")) & ~F.contains(right_side, F.lit("\n"))
    before, after = F.substring_index(left_side, "\n", -1), F.substring_index(right_side, "\n", 1)
    left = _terms(F.when(broken_left, F.regexp_replace(before, r"^\p{L}+", "")).otherwise(before))
    right = _terms(F.when(broken_right, F.regexp_replace(after, r"\p{L}+$", "")).otherwise(after))
    words = F.concat(F.slice(F.reverse(left), 1, rule.reach), F.slice(right, 1, rule.reach))
    value = F.when(F.col("s.kind") == 0, F.lower("s.value")).otherwise(F.regexp_replace("s.value", "[^0-9.]", ""))
    entity = F.sha2(F.concat_ws(":", F.col("s.kind"), value), 256)
    return seen.select("_id", entity.alias("entity"), F.xxhash64("_whole", words).alias("context"), F.explode(F.array_distinct(words)).alias("term"))


def disclosing_terms(docs: DataFrame, rule: Disclosure = Disclosure()) -> Stored:
    """For each id, the terms of its text that give some entity away, from counts over all documents."""
    text = docs.select(F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("_text"))
    held = store(with_spans(text).where(F.size("_base") > 0)).df
    near = store(_near(held, rule)).df
    per_doc = near.select("entity", "_id").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"))
    contexts = near.select("entity", "term", "context").distinct().groupBy("entity", "term").agg(F.count(F.lit(1)).alias("contexts"))
    together = near.select("entity", "term", "_id").distinct().groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_et"))
    pairs = contexts.where(F.col("contexts") >= rule.min_contexts).join(together, ["entity", "term"]).join(per_doc, "entity")
    # The documents with any entity are some of those that have a term. A term that already says too
    # little by their number cannot say more by its full count.
    n = docs.count()
    in_held = held.select(F.explode(F.array_distinct(_terms(F.col("_text")))).alias("term"))
    some = in_held.groupBy("term").agg(F.count(F.lit(1)).alias("some"))
    pairs = pairs.where(F.col("n_e") < n).join(some, "term").where(_told("some", n) >= rule.generalise_from)
    pairs = store(pairs.select("entity", "term", "n_et", "n_e"), 192)
    wanted = store(pairs.df.select("term").distinct(), 64)
    words = text.select("_id", F.explode(F.array_distinct(_terms(F.col("_text")))).alias("word"))
    seen = store(lookup(words, wanted, {"word": "term"}, "inner"), 64).df
    df = seen.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    scored = pairs.df.join(df, F.col("word") == F.col("term"))
    terms = scored.groupBy("word").agg(F.max(_told("df", n)).alias("disclosure")).where(F.col("disclosure") >= rule.generalise_from)
    found = seen.distinct().join(terms, "word").groupBy("_id")
    return store(found.agg(F.sort_array(F.collect_set(F.struct(F.col("word").alias("t"), "disclosure"))).alias("_found")), 4096)


def _told(count: str, n: int) -> Column:
    """The share of an entity's information that a term gives, if ``count`` documents have the term."""
    times = F.greatest(F.col(count) / F.col("n_et"), F.lit(1.0))
    return 1 - F.log(times) / F.log(F.lit(float(n)) / F.col("n_e"))


def marked(rows: DataFrame, docs: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """Adds ``_base`` and ``_all`` (with the terms) to rows with _id and _text, taken from ``docs``."""
    found = disclosing_terms(docs, rule)
    key = F.coalesce(F.concat(F.lit("="), F.col("_id").cast("string")), F.lit(""))
    found = Stored(found.df.select(key.alias("_key"), "_found"), found.rows, found.row_bytes)
    df = with_spans(lookup(rows.withColumn("_key", key), found, {"_key": "_key"}).drop("_key"))
    words = F.array_join(F.transform("_found", lambda x: x["t"]), "|")
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), words, F.lit(r")(?!\p{L})"))
    at = _located(F.col("_text"), pattern, KINDS.index("term"))
    df = df.withColumn("_term", F.when(F.col("_found").isNotNull(), at).otherwise(F.array().cast(f"array<{_SPAN}>")))
    free = F.filter("_term", lambda t: ~F.exists("_base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    return df.withColumn("_all", F.sort_array(F.concat("_base", free))).drop("_term")


def _written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def find(docs: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """The spans of each document."""
    rows = docs.select(F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("_text"))
    df = marked(rows, docs, rule)
    counts = [F.size(F.filter("_base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{kind}") for k, kind in enumerate(PATTERNS)]
    return df.select(F.col("_id").alias("doc_id"), *counts, F.sha2(_written(F.col("_base")), 256).alias("base_sha256"), _written(F.col("_all")).alias("spans"))


def sanitise(docs: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """The documents with entities replaced by their kind, and terms generalised or removed."""
    df = marked(with_row(docs, _id=docs["doc_id"], _text=F.coalesce(docs["text"], F.lit(""))), docs, rule)
    strong = F.transform(F.filter("_found", lambda x: x["disclosure"] >= rule.remove_from), lambda x: x["t"])
    df = df.withColumn("_strong", F.coalesce(strong, F.array().cast("array<string>")))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    text = F.col("_text")

    def step(a: Column, s: Column) -> Column:
        label = F.when(F.array_contains("_strong", F.lower(s["value"])) & (s["kind"] == KINDS.index("term")), "").otherwise(F.get(names, s["kind"]))
        more = F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), label)
        return F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(s["start"] >= a["at"], more).otherwise(a["out"]).alias("out"),
        )

    done = F.aggregate("_all", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step)
    df = df.withColumn("_done", done)
    clean = F.concat(F.col("_done.out"), F.substring(text, F.col("_done.at") + 1, F.char_length(text)))
    kept = [F.col(f"_row.`{c}`").alias(c) for c in docs.columns]
    new = F.when(F.size("_all") > 0, clean).otherwise(F.col("_row.text"))
    return df.select(*[new.alias(c) if c == "text" else k for c, k in zip(docs.columns, kept)])


def op9_privacy(spark, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
