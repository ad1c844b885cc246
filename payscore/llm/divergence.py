"""Source divergence audit: which terms, and which other sources, set a source of a language apart.

Terms are runs of ASCII letters and of all characters beyond ASCII, ``A-Z`` lower-cased. A language keeps
the terms found in at least ``MIN_DOCS`` of its documents. A group (language and source) and the language
as a whole give each kept term a smoothed share in billionths, in whole numbers, and the divergence of two
shares p and q is ``(p-q)**2 div q``.

Part ``term`` ranks a group's over-represented terms by a dominance skyband. A term with a group count as
high, a language count as low and an earlier place in UTF-8 order than another never ranks behind it. So
every task keeps, of the rows it happens to hold, the terms that fewer than ``TOP`` others dominate; the
tasks' skybands are merged in two steps, and the few that are left are ranked exactly. That a smaller set
suffices needs no estimate: whatever dominates a dropped term is itself kept or dominated by terms kept.

Part ``pair`` compares every source with every other one of its language over all kept terms. Sums over the
terms neither has follow from one number, sums over the terms one of them has from its counts of counts, and
only terms both have are visited, by language and term, into one running sum per pair of sources in each task.

Nulls: text, lang and source count as empty texts; an empty source is a source like others. Equal rows are
different documents. Ties rank by UTF-8 order of the item. A language without kept terms has value 0 for all
pairs. An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payscore.llm.common import table
from payscore.shared import Stored, lookup, numbered, store

MIN_DOCS = 3
TOP = 200
# The shares' unit, and what is added to each count.
SCALE = 1_000_000_000
EXTRA = 1

#: Distinct terms a task counts before it hands them on, bytes of a text it splits at a time, rows it holds
#: for a skyband, and pairs of sources it works on at a time.
HELD, PIECE, BUFFER, PAIRS = 600_000, 1 << 20, 1 << 19, 1 << 20
#: Parts of a group whose skybands are merged before those of the whole group.
PARTS = 16

# Bytes outside terms become spaces, A-Z become a-z. Bytes of characters beyond ASCII are 0x80 or more.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else 32 if b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b for b in range(256)
)


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """A text's terms, a long text's piece by piece."""
    folded, start = text.translate(_FOLD), 0
    while start < len(folded):
        end = len(folded) if start + PIECE >= len(folded) else folded.find(b" ", start + PIECE)
        end = len(folded) if end < 0 else end
        yield folded[start:end].split()
        start = end


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Summed counts and documents per (lang, source, term), handed on whenever enough are held."""

    def handed_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), (counts, docs) in held.items():
            term = pa.array(list(counts), pa.binary()).cast(pa.string())
            arrays = [
                pa.repeat(lang, len(counts)),
                pa.repeat(source, len(counts)),
                term,
                pa.array(list(counts.values()), pa.int64()),
                pa.array(list(map(docs.__getitem__, counts)), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["lang", "source", "term", "cnt", "docs"])

    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0
    for batch in batches:
        langs, sources, texts = batch.columns
        for i in range(batch.num_rows):
            counts, docs = held.setdefault((langs[i].as_py(), sources[i].as_py()), (Counter(), Counter()))
            size -= len(counts)
            different: set[bytes] = set()
            for terms in _pieces(texts[i].as_py()):
                counts.update(terms)
                different.update(terms)
            docs.update(different)
            size += len(counts)
            if size >= HELD:
                yield from handed_on()
                held, size = {}, 0
    yield from handed_on()


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> Stored:
    """Counts of the terms that a language keeps: lang, source, term, cnt, of_lang, first.

    ``of_lang`` is the count in the whole language; ``first`` marks one row of each language's term.
    """
    words = docs.select("lang", "source", F.encode("text", "UTF-8").alias("text")).mapInArrow(
        _count_terms, "lang string, source string, term string, cnt long, docs long"
    )
    counts = words.groupBy("lang", "source", "term").agg(F.sum("cnt").alias("cnt"), F.sum("docs").alias("docs"))
    # One row for each source of the language, so the window's groups are small.
    same = Window.partitionBy("lang", "term")
    counts = counts.withColumns(
        {
            "of_lang": F.sum("cnt").over(same),
            "in_docs": F.sum("docs").over(same),
            "first": F.col("source") == F.min("source").over(same),
        }
    )
    return store(counts.where(F.col("in_docs") >= min_docs).select("lang", "source", "term", "cnt", "of_lang", "first"))


def share(cnt: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (cnt + 1) / (total + terms)), exact; null without terms."""
    top = (cnt + EXTRA).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = F.when(terms > 0, (total + terms * EXTRA).cast("decimal(20,0)"))
    return F.call_function("div", top, below) + 1


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def groups_of(docs: DataFrame, kept: Stored) -> Stored:
    """Every (lang, source) with a number g: total counts, the language's terms, and the share of an absent term."""
    every = docs.select("lang", "source").distinct()
    own = kept.df.groupBy(F.col("lang").alias("_l"), F.col("source").alias("_s")).agg(F.sum("cnt").alias("total"))
    whole = kept.df.groupBy(F.col("lang").alias("_l")).agg(
        F.sum("cnt").alias("lang_total"), F.count(F.when(F.col("first"), 1)).alias("terms")
    )
    every = lookup(every, store(own), {"lang": "_l", "source": "_s"})
    every = lookup(every, store(whole), {"lang": "_l"})
    every = store(every.na.fill(0, ["total", "lang_total", "terms"]).withColumn("_all", F.lit(0)))
    named = numbered(every, "_all", [F.col("lang"), F.col("source")], "g").drop("_all")
    return store(named.withColumn("none", share(F.lit(0), F.col("total"), F.col("terms"))))


# Part "term"


def _dominated(of_lang: np.ndarray, place: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """Which points k or more others dominate, for points in the order of count (falling), of_lang, place.

    ``starts`` begin the runs of equal (count, of_lang). All that may dominate a point come before it, and
    only kept points need to be looked at.
    """
    n = len(place)
    out = np.ones(n, bool)
    langs, places, size = np.empty(n, of_lang.dtype), np.empty(n, place.dtype), 0
    for a, b in zip(starts, np.append(starts[1:], n)):
        b = min(b, a + k)  # the others of the run have k before them in it
        better = places[:size][langs[:size] <= of_lang[a]]
        if len(better) >= k and a + 1 == b:
            fits = np.array([np.count_nonzero(better < place[a]) < k])
        else:
            better.sort()
            fits = np.searchsorted(better, place[a:b]) + np.arange(b - a) < k
        out[a:b] = ~fits
        more = int(fits.sum())
        langs[size : size + more] = of_lang[a]
        places[size : size + more] = place[a:b][fits]
        size += more
    return out


def _skybands(rows: pa.Table, k: int) -> pa.Table:
    """The rows (g, cnt, of_lang, term) that fewer than k others of their group dominate."""
    if not rows.num_rows:
        return rows
    order = [("g", "ascending"), ("cnt", "descending"), ("of_lang", "ascending"), ("term", "ascending")]
    rows = rows.take(pc.sort_indices(rows, sort_keys=order)).combine_chunks()
    g, cnt, of_lang = (rows[c].to_numpy() for c in ("g", "cnt", "of_lang"))
    place = pc.rank(rows["term"].combine_chunks(), tiebreaker="dense").to_numpy().astype(np.int64)
    new_group = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
    new_run = np.append(True, (g[1:] != g[:-1]) | (cnt[1:] != cnt[:-1]) | (of_lang[1:] != of_lang[:-1]))
    keep = np.zeros(len(g), bool)
    for a, b in zip(new_group, np.append(new_group[1:], len(g))):
        keep[a:b] = ~_dominated(of_lang[a:b], place[a:b], np.flatnonzero(new_run[a:b]), k)
    return rows.filter(pa.array(keep))


def skyband(rows: DataFrame, k: int = TOP) -> DataFrame:
    """Of the rows (g, cnt, of_lang, term) of each task, those that fewer than k others of their group dominate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= BUFFER:
                best = _skybands(pa.Table.from_batches(held), k)
                # What is left counts for half at most, so a large skyband is not sorted at every batch.
                held, size = best.to_batches(), min(best.num_rows, BUFFER // 2)
        if held:
            yield from _skybands(pa.Table.from_batches(held), k).to_batches(max_chunksize=10_000)

    return rows.select("g", "cnt", "of_lang", "term").mapInArrow(run, "g int, cnt long, of_lang long, term string")


def _with_groups(rows: DataFrame, groups: Stored, *columns: str) -> DataFrame:
    names = groups.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), "g", *columns)
    return lookup(rows, names, {"lang": "_l", "source": "_s"}, how="inner")


def top_terms(kept: Stored, groups: Stored, top: int = TOP) -> DataFrame:
    """Part ``term``: lang, source, item, value, rank."""
    totals = ["total", "lang_total", "terms"]
    p = share(F.col("cnt"), F.col("total"), F.col("terms"))
    q = share(F.col("of_lang"), F.col("lang_total"), F.col("terms"))
    over = _with_groups(kept.df, groups, *totals).where(p > q)
    best = skyband(over, top)
    best = skyband(best.repartition("g", F.pmod(F.xxhash64("term"), F.lit(PARTS))), top)
    best = skyband(best.repartition("g"), top)
    best = lookup(best.withColumnRenamed("g", "_g"), groups.select("g", "lang", "source", *totals), {"_g": "g"}, how="inner")
    valued = best.select("_g", "lang", "source", F.col("term").alias("item"), divergence(p, q).alias("value"))
    rank = F.row_number().over(Window.partitionBy("_g").orderBy(F.desc("value"), "item"))
    return valued.withColumn("rank", rank).where(F.col("rank") <= top).drop("_g")


# Part "pair"


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _shared_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per pair of groups over the terms both have, from rows sorted by language and term.

    What the terms add beyond the sums that take each of them as absent from one of the groups.
    """

    def handed_on() -> pa.RecordBatch:
        codes = np.array(list(sums), np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array((codes >> 32).astype(np.int32)), pa.array((codes & 0xFFFFFFFF).astype(np.int32)), pa.array(list(sums.values()), pa.int64())],
            ["a", "b", "part"],
        )

    def add(rows: pa.Table, starts: np.ndarray) -> None:
        g, p, none = (rows[c].to_numpy().astype(np.int64) for c in ("g", "p", "none"))
        sizes = np.diff(np.append(starts, len(g)))
        first, width = np.repeat(starts, sizes), np.repeat(sizes, sizes)
        ends = np.cumsum(width)
        at = 0
        while at < len(g):
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
            many = width[at:upto]
            left = np.repeat(np.arange(at, upto), many)
            right = np.arange(len(left)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first[at:upto], many)
            left, right = left[left != right], right[left != right]
            more = _f(p[left], p[right]) - _f(p[left], none[right]) - _f(none[left], p[right]) + _f(none[left], none[right])
            codes = (g[left] << 32) | g[right]
            order = np.argsort(codes, kind="stable")
            codes = codes[order]
            if len(codes):
                runs = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
                for code, value in zip(codes[runs].tolist(), np.add.reduceat(more[order], runs).tolist()):
                    sums[code] = sums.get(code, 0) + value
            at = upto

    sums: dict[int, int] = {}
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = (rows if rest is None else pa.concat_tables([rest, rows])).combine_chunks()
        if not rows.num_rows:
            continue
        new = np.ones(rows.num_rows, bool)
        if rows.num_rows > 1:
            differs = [pc.not_equal(rows[c][1:], rows[c][:-1]).to_numpy() for c in ("lang", "term")]
            new[1:] = differs[0] | differs[1]
        starts = np.flatnonzero(new)
        # The last term may go on in the next batch.
        rest = rows.slice(starts[-1])
        add(rows.slice(0, starts[-1]), starts[:-1])
        if len(sums) > PAIRS:
            yield handed_on()
            sums = {}
    if rest is not None:
        add(rest, np.zeros(1, np.int64))
    if sums:
        yield handed_on()


def source_pairs(kept: Stored, groups: Stored) -> DataFrame:
    """Part ``pair``: lang, source, item, value, rank."""
    p = share(F.col("cnt"), F.col("total"), F.col("terms"))
    named = _with_groups(kept.df, groups, "total", "terms", "none")
    named = store(named.select("lang", "term", "g", p.alias("p"), "none")).df
    both = named.repartition("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(_shared_terms, "a int, b int, part long")
    both = both.select("a", "b", F.col("part").cast("decimal(38,0)").alias("part"))

    others = groups.select(F.col("g").alias("h"), F.col("lang").alias("_l"), F.col("none").alias("q"), F.col("terms").alias("_t"))
    # How often a group has each share: far fewer rows than terms.
    shares = store(named.groupBy("lang", "g", "p", "none").agg(F.count(F.lit(1)).alias("n"))).df
    met = lookup(shares, others.select("h", "_l", "q"), {"lang": "_l"}, how="inner").where("g <> h")
    n = F.col("n").cast("decimal(18,0)")

    def extra(here: Column, absent: Column) -> Column:
        return (n * (here - absent).cast("decimal(20,0)")).cast("decimal(38,0)")

    none, q, p = F.col("none"), F.col("q"), F.col("p")
    ways = F.array(
        F.struct(F.col("g").alias("a"), F.col("h").alias("b"), extra(divergence(p, q), divergence(none, q)).alias("part")),
        F.struct(F.col("h").alias("a"), F.col("g").alias("b"), extra(divergence(q, p), divergence(q, none)).alias("part")),
    )
    single = met.select(F.inline(ways))
    base = lookup(groups.df.select("lang", "g", "none"), others, {"lang": "_l"}, how="inner").where("g <> h")
    absent = F.col("_t").cast("decimal(18,0)") * F.coalesce(divergence(none, q), F.lit(0)).cast("decimal(20,0)")
    base = base.select(F.col("g").alias("a"), F.col("h").alias("b"), absent.cast("decimal(38,0)").alias("part"))

    sums = base.unionByName(single).unionByName(both).groupBy("a", "b").agg(F.sum("part").cast("long").alias("value"))
    item = groups.select(F.col("g").alias("_b"), F.col("source").alias("item"))
    sums = lookup(sums, item, {"b": "_b"}, how="inner")
    ranked = numbered(store(sums), "a", [F.desc("value"), F.asc("item")], "rank")
    ranked = lookup(ranked, groups.select("g", "lang", "source"), {"a": "g"}, how="inner")
    return ranked.select("lang", "source", "item", "value", "rank")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank, for documents with text, lang and source."""
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    kept = kept_terms(docs, min_docs)
    groups = groups_of(docs, kept)
    pairs = source_pairs(kept, groups).withColumn("part", F.lit("pair"))
    terms = top_terms(kept, groups, top).withColumn("part", F.lit("term"))
    columns = ["lang", "source", "part", "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank")]
    return pairs.select(*columns).unionByName(terms.select(*columns))


def op11_divergence(spark, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


#: Every group with every kept term of its language, one by one.
OP11_SQL = r"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source
  FROM documents
), words AS MATERIALIZED (
  SELECT id, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM docs
), kept AS MATERIALIZED (
  SELECT lang, term, count(*) AS cnt FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 3
), whole AS MATERIALIZED (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (cnt + 1)) // (sum(cnt) OVER w + count(*) OVER w) AS q FROM kept
  WINDOW w AS (PARTITION BY lang)
), counts AS MATERIALIZED (
  SELECT lang, source, term, count(*) AS cnt FROM words GROUP BY ALL
), filled AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.cnt, 0) AS cnt
  FROM (SELECT DISTINCT lang, source FROM docs) g JOIN kept k ON k.lang = g.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), shares AS MATERIALIZED (
  SELECT lang, source, term, cnt, 1 + (1000000000::HUGEINT * (cnt + 1)) // (sum(cnt) OVER w + count(*) OVER w) AS p FROM filled
  WINDOW w AS (PARTITION BY lang, source)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(v.value, 0) AS value
  FROM (SELECT DISTINCT lang, source FROM docs) a JOIN (SELECT DISTINCT lang, source FROM docs) b
    ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS value
             FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) v
    ON v.lang = a.lang AND v.source = a.source AND v.item = b.source
), over_shares AS (
  SELECT s.lang, s.source, s.term AS item, ((p - q) * (p - q)) // q AS value
  FROM shares s JOIN whole w ON w.lang = s.lang AND w.term = s.term WHERE s.cnt > 0 AND p > q
), ranked AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM over_shares
)
SELECT lang, source, part, item, value::BIGINT AS value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM ranked QUALIFY part = 'pair' OR rank <= 200
"""
