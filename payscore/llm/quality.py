"""Quality rules: base counts of a text, and its divergence from what its language looks like.

The method compares two histograms of a document with those of its language, by the Jensen-Shannon
divergence in bits (0: equal, 1: nothing in common): one over classes of characters, one over the
commonest words of the language and "any other". Common words and references come from counts over all
documents. A language with at least 1 / ``lang_share`` of the documents has references of its own, so
there are at most ``lang_share`` of them. Documents of any other language, or of none, are compared by
characters with all documents, and not by words: clean texts of a rare language share few with others.
A short text differs from its language by chance: the limit of a comparison is wider by
``spread`` times the divergence expected of a sample of as many draws as the text has words,
(bins - 1) / (8 ln 2 words). Characters of a word go together, so words count there as well.

Words are counted by language with partial sums before the one large shuffle; the rest is expressions
on the row and small sums.

Nulls: a null text has no words, fails the base rule and so is not kept. A null language is as above.
Of equally common words the first by code point is taken. An empty table gives an empty result.
Repeated rows are judged alike, and each counts for the references.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payscore.llm.common import WORD, table, unpack, with_row, words_of
from payscore.shared import UNMEASURED, store, with_total

# Classes of characters. What belongs to none of them (small letters, mostly) is one more.
CHAR_CLASSES = [r"\p{Lu}", r"\p{Nd}", r".,;:!?'\"()\-", r"#*$%&|<>"]
SYMBOLS = 3

ANY = "*"


@dataclass(frozen=True)
class Rules:
    """Limits of the verdict, and how many words a language's histogram of words has."""

    min_words: int = 10
    max_repeat_percent: int = 20
    max_chars_divergence: float = 0.05
    max_words_divergence: float = 0.045
    spread: float = 3.0
    common_words: int = 12
    lang_share: int = 1000


def _length_of(text: Column, chars: str) -> Column:
    """How many characters of a class a text has."""
    return F.char_length(F.regexp_replace(text, f"[^{chars}]+", "")).cast("long")


@dataclass(frozen=True)
class Common:
    """The languages with references of their own, and the commonest words of each with their shares."""

    langs: list[str]
    words: dict[str, list[str]]
    shares: dict[str, list[float]]


def common_words(rows: DataFrame, rules: Rules) -> Common:
    """Counted over all rows (_text, _lang); at most ``lang_share`` lists of ``common_words`` words reach the driver."""
    sizes = rows.groupBy("_lang").agg(F.count(F.lit(1)).alias("n"))
    large = with_total(sizes, sizes.agg(F.sum("n").alias("all"))).where(F.col("n") * rules.lang_share >= F.col("all"))
    langs = sorted(r["_lang"] for r in large.where(F.col("_lang") != ANY).select("_lang").collect())
    own = rows.where(F.col("_lang").isin(langs))
    words = own.select(F.col("_lang").alias("ref"), F.explode(words_of(F.col("_text"))).alias("word"))
    counts = store(words.groupBy("ref", "word").agg(F.count(F.lit(1)).alias("n")), UNMEASURED).df
    totals = {r["ref"]: r["n"] for r in counts.groupBy("ref").agg(F.sum("n").alias("n")).collect()}
    place = F.row_number().over(Window.partitionBy("ref").orderBy(F.desc("n"), "word"))
    top = counts.withColumn("place", place).where(F.col("place") <= rules.common_words).collect()
    found: dict[str, list] = {}
    for r in sorted(top, key=lambda r: (r["ref"], r["place"])):
        found.setdefault(r["ref"], []).append(r)
    shares = {k: [r["n"] / totals[k] for r in v] for k, v in found.items()}
    # "Any other" from whole numbers: what is left of shares may be a little under 0.
    rest = {k: (totals[k] - sum(r["n"] for r in v)) / totals[k] for k, v in found.items()}
    return Common(langs, {k: [r["word"] for r in v] for k, v in found.items()}, {k: [*v, rest[k]] for k, v in shares.items()})


def _literal_map(values: dict[str, list], kind: str) -> Column:
    items = [x for k, v in values.items() for x in (F.lit(k), F.array(*map(F.lit, v)))]
    return (F.create_map(*items) if items else F.create_map()).cast(f"map<string,array<{kind}>>")


def _histograms(df: DataFrame, common: Common) -> DataFrame:
    """Adds ``_chars`` and ``_common``, the counts of both histograms, to rows with _text, _words and _lang."""
    # What is left without small letters and blanks is short, and holds all the counted classes.
    rare = F.regexp_replace("_text", r"[a-z\x20\p{Ll}]+", "")
    df = df.withColumn("_rare", rare).withColumn("_word_chars", F.char_length(F.array_join("_words", "")).cast("long"))
    spaces = F.char_length("_text").cast("long") - F.col("_word_chars")
    df = df.withColumn("_classes", F.array(*[_length_of(F.col("_rare"), c) for c in CHAR_CLASSES], spaces))
    n, places = F.size("_words"), max(map(len, common.words.values()), default=0)
    df = df.withColumn("_list", F.element_at(_literal_map(common.words, "string"), F.coalesce("_lang", F.lit(ANY))))
    counts = [n - F.size(F.array_remove("_words", F.coalesce(F.get("_list", F.lit(k)), F.lit("")))) for k in range(places)]
    listed = F.slice(F.array(*counts).cast("array<long>"), F.lit(1), F.coalesce(F.size("_list"), F.lit(0)))
    df = df.withColumn("_counts", F.when(F.col("_list").isNotNull(), listed))
    return df.withColumns(
        {
            "_chars": _with_rest(F.col("_classes"), F.char_length("_text").cast("long")),
            "_common": _with_rest(F.col("_counts"), n.cast("long")),
        }
    ).drop("_classes", "_list", "_counts", "_rare")


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)


def _with_rest(counts: Column, total: Column) -> Column:
    return F.concat(counts, F.array(total - _total(counts)))


def char_shares(seen: DataFrame) -> dict[str, list[float]]:
    """The distribution of characters of each language with references of its own, and of all documents under ``*``.

    One row per such language reaches the driver.
    """
    width = len(CHAR_CLASSES) + 2
    rows = seen.groupBy("_lang").agg(*[F.sum(F.get("_chars", F.lit(i))).alias(f"c{i}") for i in range(width)]).collect()
    found = {r["_lang"]: [r[f"c{i}"] for i in range(width)] for r in rows if r["_lang"] is not None}
    found[ANY] = [sum(r[f"c{i}"] for r in rows) for i in range(width)]
    return {k: [x / sum(v) for x in v] for k, v in found.items() if sum(v)}


def divergence(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon divergence in bits of a histogram and a distribution; null if either is empty."""
    total = _total(counts)
    share = F.transform(counts, lambda x: x / total)

    def term(p: Column, q: Column) -> Column:
        m = (p + q) / 2
        of = lambda x: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
        return (of(p) + of(q)) / 2

    parts = F.zip_with(share, reference, term)
    return F.when(total > 0, F.aggregate(parts, F.lit(0.0), lambda a, x: a + x))


def by_chance(bins: int) -> Column:
    """The divergence to be expected of a sample of a text's words from its own distribution."""
    return (bins - 1) / (8 * math.log(2) * F.greatest("_n", F.lit(1)))


def _repeated(df: DataFrame) -> DataFrame:
    """Adds ``_repeat``: the number of words that lie in a window of five found twice or more.

    Windows are compared by 64-bit hashes. Only texts that have a repeated window sort theirs; its
    places are then merged to the words they cover.
    """
    size = lambda column, by: F.greatest(F.size(column) - by, F.lit(0))
    shifted = lambda column, by: F.slice(column, by + 1, size(column, by))
    cut = lambda column, by: F.slice(column, 1, size(column, by))
    both = lambda a, b: F.xxhash64(a, b)
    # Windows of two, four and five words, each from two shorter ones.
    df = df.withColumn("_one", F.transform("_words", lambda w: F.xxhash64(w)))
    df = df.withColumn("_two", F.zip_with(cut("_one", 1), shifted("_one", 1), both))
    df = df.withColumn("_four", F.zip_with(cut("_two", 2), shifted("_two", 2), both))
    df = df.withColumn("_windows", F.zip_with(cut("_four", 1), shifted("_one", 4), both)).drop("_one", "_two", "_four")
    twice = F.size(F.array_distinct("_windows")) < F.size("_windows")
    pairs = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    df = df.withColumn("_sorted", F.when(twice, F.sort_array(pairs))).drop("_windows")
    same = lambda j: F.get("_sorted", j)["h"]
    order = F.sequence(F.lit(0), F.size("_sorted") - 1)
    equal = lambda a, b: F.coalesce(same(a) == same(b), F.lit(False))
    again = F.filter(order, lambda j: equal(j, j - 1) | equal(j, j + 1))
    found = F.array_sort(F.transform(again, lambda j: F.get("_sorted", j)["i"]))
    df = df.withColumn("_places", F.when(F.col("_sorted").isNotNull(), found)).drop("_sorted")
    start = F.struct(F.lit(-5).alias("last"), F.lit(0).alias("n"))
    step = lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(5), x - a["last"])).alias("n"))
    covered = F.aggregate("_places", start, step)["n"]
    return df.withColumn("_repeat", F.coalesce(covered, F.lit(0)).cast("long")).drop("_places")


def measured(rows: DataFrame, common: Common) -> DataFrame:
    """Adds all counts to rows with _text and _lang, and drops the text."""
    df = _histograms(rows.withColumn("_words", words_of(F.col("_text"))), common)
    df = _repeated(df)
    lines = F.filter(F.split("_text", "\n"), lambda x: F.rlike(x, F.lit(WORD)))
    df = df.withColumn("_lines", lines).withColumn("_n", F.size("_words").cast("long"))
    return df.withColumns(
        {
            "_symbols": F.get("_chars", F.lit(SYMBOLS)),
            "_dups": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        }
    ).drop("_words", "_lines", "_text")


def judged(rows: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Rows with _text and _lang, with their counts, divergences, and ``_kept`` instead of the text.

    Words are counted first; counts of the rows are written once, and the references of characters are
    summed from them before any row can be judged.
    """
    rows = rows.withColumn("_text", F.coalesce("_text", F.lit("")))
    common = common_words(rows, rules)
    listed = F.when(F.col("_lang").isin(common.langs), F.col("_lang"))
    df = store(measured(rows.withColumn("_lang", listed), common), UNMEASURED).df
    ref = F.coalesce("_lang", F.lit(ANY))
    by_char = divergence(F.col("_chars"), F.element_at(_literal_map(char_shares(df), "double"), ref))
    by_word = divergence(F.col("_common"), F.element_at(_literal_map(common.shares, "double"), ref))
    df = df.withColumn("_by_char", by_char).withColumn("_by_word", by_word)
    failed = (F.col("_n") < rules.min_words) | (100 * F.col("_repeat") > rules.max_repeat_percent * F.col("_n"))
    odd = F.col("_by_char") > rules.max_chars_divergence + rules.spread * by_chance(len(CHAR_CLASSES) + 2)
    strange = F.col("_by_word") > rules.max_words_divergence + rules.spread * by_chance(rules.common_words + 1)
    odd, strange = F.coalesce(odd, F.lit(False)), F.coalesce(strange, F.lit(False))
    return df.withColumn("_failed", failed).withColumn("_kept", ~failed & ~odd & ~strange)


def assess(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The counts, divergences and verdict of each document."""
    names = {
        "_n": "n_words", "_word_chars": "word_chars", "_symbols": "n_symbols", "_dups": "n_dup_lines",
        "_repeat": "n_repeat_words", "_failed": "base_failed", "_kept": "kept",
        "_by_char": "chars_divergence", "_by_word": "words_divergence",
    }
    rows = docs.select("doc_id", F.col("text").alias("_text"), F.col("lang").alias("_lang"))
    return judged(rows, rules).select("doc_id", *[F.col(k).alias(v) for k, v in names.items()])


def keep_good(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that pass, with their own columns."""
    return unpack(judged(with_row(docs, _text=docs["text"], _lang=docs["lang"]), rules).where("_kept"))


def op8_quality(spark, sf_dir: str) -> DataFrame:
    return assess(table(spark, sf_dir, "documents")).drop("chars_divergence", "words_divergence")


def _sql(rules: Rules = Rules()) -> str:
    """The same in SQL: windows and histograms as rows."""
    words = r"[^\x20\x09-\x0D]+"
    classes = [r"\p{Lu}", r"\p{Nd}", r".,;:!?''\"()\-", "#*$%&|<>"]
    counts = ", ".join(f"length(regexp_replace(text, '[^{c}]+', '', 'g')) AS c{k}" for k, c in enumerate(classes))
    last = len(classes)
    chars = " UNION ALL ".join(f"SELECT rid, ref, n_chars AS total, {k} AS k, c{k} AS n FROM h" for k in range(last))
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text FROM documents),
langs AS (
  SELECT lang FROM d WHERE lang IS NOT NULL AND lang <> '{ANY}' GROUP BY lang
  HAVING count(*) * {rules.lang_share} >= (SELECT count(*) FROM d)
),
w AS (
  SELECT *, regexp_extract_all(text, '{words}') AS words, length(text) AS n_chars, {counts},
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{words}')) AS lines,
         coalesce((SELECT l.lang FROM langs l WHERE l.lang = d.lang), '{ANY}') AS ref
  FROM d
), h AS (SELECT *, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars FROM w),
said AS (SELECT ref, word, count(*) AS n FROM (SELECT ref, unnest(words) AS word FROM h) GROUP BY ref, word),
listed AS (
  SELECT ref, word, row_number() OVER (PARTITION BY ref ORDER BY n DESC, word) AS k,
         n / sum(n) OVER (PARTITION BY ref) AS q, sum(n) OVER (PARTITION BY ref) AS total, n
  FROM said WHERE ref <> '{ANY}' QUALIFY k <= {rules.common_words}
), five AS (
  SELECT rid, i, array_to_string(words[i:i + 4], ' ') AS t
  FROM (SELECT rid, words, unnest(range(1, len(words) - 3)) AS i FROM h)
), twice AS (SELECT rid, i FROM five QUALIFY count(*) OVER (PARTITION BY rid, t) > 1),
covered AS (SELECT rid, count(DISTINCT i + o) AS n FROM twice, range(5) AS r(o) GROUP BY rid),
some_chars AS ({chars} UNION ALL SELECT rid, ref, n_chars, {last}, n_chars - word_chars FROM h),
chars AS (
  SELECT * FROM some_chars
  UNION ALL SELECT rid, any_value(ref), any_value(total), {last + 1}, any_value(total) - sum(n) FROM some_chars GROUP BY rid
), some_terms AS (
  SELECT rid, ref, n_words AS total, k, len(list_filter(words, lambda x: x = word)) AS n FROM h JOIN listed USING (ref)
), terms AS (
  SELECT * FROM some_terms
  UNION ALL SELECT rid, any_value(ref), any_value(total), -1, any_value(total) - sum(n) FROM some_terms GROUP BY rid
), char_refs AS (
  SELECT ref, k, sum(n) / sum(sum(n)) OVER (PARTITION BY ref) AS q FROM chars WHERE ref <> '{ANY}' GROUP BY ref, k
  UNION ALL SELECT '{ANY}', k, sum(n) / sum(sum(n)) OVER () FROM chars GROUP BY k
), term_refs AS (
  SELECT ref, k, q FROM listed
  UNION ALL SELECT ref, -1, (any_value(total) - sum(n)) / any_value(total) FROM listed GROUP BY ref
),
shares AS (
  SELECT 'c' AS kind, rid, n / total AS p, q FROM chars JOIN char_refs USING (ref, k) WHERE total > 0
  UNION ALL SELECT 'w', rid, n / total, q FROM terms JOIN term_refs USING (ref, k) WHERE total > 0
), apart AS (
  SELECT kind, rid, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2 AS bits
  FROM shares GROUP BY kind, rid
), judged AS (
  SELECT doc_id, n_words, word_chars, c3 AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words, a.bits AS by_char, b.bits AS by_word
  FROM h LEFT JOIN covered USING (rid) LEFT JOIN apart a ON a.rid = h.rid AND a.kind = 'c' LEFT JOIN apart b ON b.rid = h.rid AND b.kind = 'w'
), failed AS (
  SELECT *, n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_percent} * n_words AS base_failed FROM judged
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed
       AND NOT coalesce(by_char > {rules.max_chars_divergence} + {rules.spread} * {last + 1} / (8 * ln(2) * greatest(n_words, 1)), false)
       AND NOT coalesce(by_word > {rules.max_words_divergence} + {rules.spread} * {rules.common_words} / (8 * ln(2) * greatest(n_words, 1)), false) AS kept
FROM failed
"""


OP8_SQL = _sql()
