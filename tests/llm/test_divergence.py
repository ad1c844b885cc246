"""The source divergence audit against its definition, text by text."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from payscore.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, min_docs=3, top=200):
    """lang, source, part, item, value, rank for (text, lang, source)."""
    lower = {c: c + 32 for c in range(65, 91)}
    counts, seen = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in docs:
        terms = TERM.findall((text or "").translate(lower))
        counts[lang or "", source or ""].update(terms)
        seen[lang or ""].update(set(terms))
    out = set()
    for lang in seen:
        kept = sorted(t for t, n in seen[lang].items() if n >= min_docs)
        sources = [s for l, s in counts if l == lang]

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (total + len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))

        def ranked(values, limit=None):
            order = sorted(values.items(), key=lambda x: (-x[1], x[0].encode()))
            return [(item, value, i + 1) for i, (item, value) in enumerate(order[:limit])]

        for s in sources:
            pairs = {o: sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept) for o in sources if o != s}
            terms = {t: (p[s][t] - q[t]) ** 2 // q[t] for t in kept if counts[lang, s][t] and p[s][t] > q[t]}
            out |= {(lang, s, "pair", *r) for r in ranked(pairs)} | {(lang, s, "term", *r) for r in ranked(terms, top)}
    return out


def made(seed, n=300, words=120):
    rng = random.Random(seed)
    vocabulary = [w * (1 + i % 3) for i, w in enumerate("é ab Zz ß 日本 a b c x yy".split() * (words // 10))]
    vocabulary += [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(words)]
    out = []
    for _ in range(n):
        source = rng.choice(["hot"] * 6 + ["a", "b", "", None, "é"])
        text = " ".join(rng.choice(vocabulary)[: rng.randint(1, 6)] for _ in range(rng.randint(0, 40)))
        out.append((text + rng.choice([",x", "\n_Q!", "", "9A"]), rng.choice(["en", "en", "de", None]), source))
    return out


@pytest.mark.parametrize("top", [200, 7])
def test_as_defined(spark, top, monkeypatch):
    # Small buffers, so that skybands are merged and sums handed on many times.
    monkeypatch.setattr(divergence, "BUFFER", 40)
    monkeypatch.setattr(divergence, "HELD", 50)
    monkeypatch.setattr(divergence, "PAIRS", 30)
    monkeypatch.setattr(divergence, "PIECE", 16)
    docs = made(1) + [(None, "en", "null"), ("", "xx", "lone"), ("", "xx", "other"), ("only once", "yy", "s"), ("long " * 50_000, "en", "a")]
    docs += docs[:5]
    df = spark.createDataFrame([(*d, "z", 1) for d in docs], "text string, lang string, source string, term string, g int").repartition(5)
    got = {tuple(r) for r in divergence.audit(df, top=top).collect()}
    assert got == brute(docs, top=top)


def test_empty(spark):
    empty = spark.createDataFrame([], "text string, lang string, source string")
    assert divergence.audit(empty).collect() == []


def test_skyband_keeps_what_few_dominate():
    rng = np.random.default_rng(3)
    n, k = 400, 5
    cnt, of_lang, place = rng.integers(1, 9, n), rng.integers(1, 9, n), rng.permutation(n)
    order = np.lexsort((place, of_lang, -cnt))
    cnt, of_lang, place = cnt[order], of_lang[order], place[order]
    starts = np.flatnonzero(np.append(True, (cnt[1:] != cnt[:-1]) | (of_lang[1:] != of_lang[:-1])))
    better = [((cnt >= cnt[i]) & (of_lang <= of_lang[i]) & (place < place[i])).sum() for i in range(n)]
    assert np.array_equal(divergence._dominated(of_lang, place, starts, k), np.array(better) >= k)
