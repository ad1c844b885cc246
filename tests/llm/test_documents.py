"""Quality, personal data, mixing, language, toxicity: rows, nulls, repeats, empty tables, other columns."""

import collections
import hashlib
import re
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from payscore.llm import language, mixing, privacy, quality, toxicity

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_id(df):
    out = collections.defaultdict(list)
    for r in df.collect():
        out[r.doc_id].append(r)
    return out


def test_quality_counts(docs_of, sample):
    rows = [*sample, (501, "a b c d e a b c d e f"), (502, "one\n \none\n one\n\n"), (503, "#*$ %&|<> é\x0bÉ"), (504, "x " * 9), (505, "y y y y y y y y y y y y")]
    got = by_id(quality.assess(docs_of(rows)))
    assert sum(map(len, got.values())) == len(rows)
    for i, text, *_ in rows:
        words = WORD.findall(text or "")
        windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
        many = collections.Counter(windows)
        twice = {p for k, w in enumerate(windows) if many[w] > 1 for p in range(k, k + 5)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        failed = len(words) < 10 or 100 * len(twice) > 20 * len(words)
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(twice), failed)
        assert any((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want for r in got[i])
        assert all(not (r.base_failed and r.kept) for r in got[i])


def test_quality_divergence(spark):
    p, q = np.array([3, 0, 5, 2]), np.array([0.1, 0.2, 0.3, 0.4])
    m = (p / 10 + q) / 2
    part = lambda x: sum(a * np.log2(a / b) for a, b in zip(x, m, strict=True) if a > 0)
    want = (part(p / 10) + part(q)) / 2
    df = spark.createDataFrame([([3, 0, 5, 2], q.tolist()), ([0, 0, 0, 0], q.tolist())], "p array<long>, q array<double>")
    a, b = [r[0] for r in df.select(quality.divergence(F.col("p"), F.col("q"))).collect()]
    assert a == pytest.approx(want) and b is None


def brute_quality(rows, rules):
    """Divergences and verdicts, with common words and references counted here."""
    langs = collections.Counter(r[2] for r in rows)
    own = {x for x, n in langs.items() if x not in (None, "*") and n * rules.lang_share >= len(rows)}
    words, chars = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)

    def classes(text):
        out = collections.Counter()
        for c in text:
            kind = unicodedata.category(c)
            if kind in ("Lu", "Nd"):
                out[kind] += 1
            else:
                out["stop" if c in ".,;:!?'\"()-" else "sign" if c in "#*$%&|<>" else "space" if c in " \t\n\x0b\f\r" else "rest"] += 1
        return out

    for _, text, lang in rows:
        for ref in {lang if lang in own else "*", "*"}:
            words[ref].update(WORD.findall(text or ""))
            chars[ref].update(classes(text or ""))

    def apart(counts, ref, keys):
        total = sum(counts[k] for k in keys)
        if not total:
            return None
        p = np.array([counts[k] / total for k in keys])
        q = np.array([ref[k] for k in keys]) / sum(ref[k] for k in keys)
        m = (p + q) / 2
        return sum((a * np.log2(a / b) if a else 0) / 2 for x in (p, q) for a, b in zip(x, m, strict=True))

    for i, text, lang in rows:
        ref, said = lang if lang in own else "*", WORD.findall(text or "")
        top = sorted(words[ref], key=lambda w: (-words[ref][w], w))[: rules.common_words]
        if ref == "*":
            top = []
        listed = lambda counts: {**{w: counts[w] for w in top}, None: sum(n for w, n in counts.items() if w not in top)}
        by_char = apart(classes(text or ""), chars[ref], ["Lu", "Nd", "stop", "sign", "space", "rest"])
        by_word = apart(listed(collections.Counter(said)), listed(words[ref]), [*top, None]) if top else None
        noise = rules.spread / (8 * np.log(2) * max(len(said), 1))
        odd = by_char is not None and by_char > rules.max_chars_divergence + 5 * noise
        yield i, by_char, by_word, odd or (by_word is not None and by_word > rules.max_words_divergence + rules.common_words * noise)


def test_quality_equals_brute_force(docs_of, sample):
    rows = [(k, r[1], r[2]) for k, r in enumerate(sample)]
    plain = [r[1].split() for r in rows if r[1] and r[2] == "en" and len(r[1].split()) > 100][:4]
    rows += [(900 + n, " ".join(w.upper() + "#%&" for w in plain[n % 4][:n]), "en") for n in (20, 40, 79, 80)]
    rows += [(1000 + n, " ".join(plain[0][:n]), lang) for n, lang in ((12, "en"), (60, None), (79, "zz"), (90, "*"))]
    rows += [(1200, "1 2 3", "zz"), (1201, "\u00c9\u00df \u0663", None)]
    rules = quality.Rules(lang_share=20)
    got = by_id(quality.assess(docs_of(rows), rules))
    for i, by_char, by_word, odd in brute_quality(rows, rules):
        (r,) = got[i]
        assert r.chars_divergence == pytest.approx(by_char) and r.words_divergence == pytest.approx(by_word)
        assert r.kept == (not r.base_failed and not odd)
    assert not any(got[i][0].kept for i in (920, 940, 979, 980)) and not any(got[i][0].base_failed for i in (920, 979))
    assert got[1012][0].kept and got[1060][0].kept


def test_quality_keeps_columns_and_clean_documents(spark, docs_of, sample):
    df = docs_of(sample)
    kept = quality.keep_good(df)
    assert kept.columns == df.columns
    judged = by_id(quality.assess(df))
    assert sorted(r.doc_id for r in kept.where("doc_id >= 0").collect()) == sorted(i for i, v in judged.items() for r in v if r.kept and i is not None and i >= 0)
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    good = quality.assess(big).join(labels, "doc_id").where("NOT base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"), F.count("*").alias("n"))
    share = {r.quality: r.kept for r in good.collect()}
    assert share[1] > 0.99 and share[0] < 0.5


def brute_spans(t):
    kinds = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]
    out = []
    for k, pattern in enumerate(kinds):
        for m in re.finditer(pattern, t):
            digits = re.sub("[^0-9]", "", m.group())
            luhn = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(digits[::-1])) % 10 == 0
            ok = [True, k == 1 and all(int(p) <= 255 for p in m.group().split(".")), 12 <= len(digits) <= 19 and luhn, 9 <= len(digits) <= 15][k]
            if ok:
                out.append((m.start(), k, m.end()))
    return ",".join(f"{privacy.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out)), collections.Counter(k for _, k, _ in out)


TRICKY = [
    "a@b.c@d.e f@g", "a@b.c_d@e.f.g 1.2.3.4.5.6.7.8 0.0.0.0 00.256.1.1", "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 1111 1111 1111",
    "+1 (555) 123-4567.. +123456789012345678 +12", "x.y@z-1.co.uk,é@b.c 😀 q@w.e", "1234567890123456789012 4111111111111111", "+1 (243) 555-5526 4111111111111111 5",
    "1" * 50_000, "1 " * 20_000, "a" * 50_000 + "@b.cd", "1." * 5000, "+1" + "(" * 10_000,
]


def test_private_spans(docs_of, sample):
    rows = [*sample, *[(2000 + i, t) for i, t in enumerate(TRICKY)]]
    got = by_id(privacy.find(docs_of(rows)))
    assert sum(map(len, got.values())) == len(rows)
    for i, text, *_ in rows:
        spans, n = brute_spans(text or "")
        for r in got[i] if i is not None and i != 7 else ():
            base = ",".join(s for s in r.spans.split(",") if s and not s.startswith("term"))
            assert base == spans and r.base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [n[k] for k in range(4)]


def test_disclosing_terms(docs_of):
    fruit = ["apple", "pear", "plum", "fig nut", "kiwi", "lime"]
    rows = [(i, f"Filler about nothing. Contact Zaphod Beeble at zb@heart.org for the ship {f} okay") for i, f in enumerate(fruit)]
    rows += [(100 + i, f"the ship filler about nothing okay {i} for contact") for i in range(60)]
    rows += [(200, "I saw Zaphod there"), (300, "Mail copy@copy.org to Trillian"), (301, "Mail copy@copy.org to Trillian"), (302, "Mail copy@copy.org to Trillian")]
    got = by_id(privacy.find(docs_of(rows)))
    assert got[200][0].spans == "term:6:12"
    assert "term" in got[0][0].spans and got[100][0].spans == ""
    assert "term" not in got[300][0].spans  # copies are one piece of evidence
    df = docs_of(rows)
    clean = privacy.sanitise(df)
    assert clean.columns == df.columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert "Zaphod" not in texts[0] + texts[200] and "[EMAIL]" in texts[0] and texts[101] == rows[7][1]


def test_disclosing_terms_at_borders_and_in_signatures(docs_of):
    rows = [(i, f"Own text number {i} {w}\nZephyr jane@x.org") for i, w in enumerate(["one", "two", "three", "four"])]
    rows += [(10 + i, f"Other {w}\njim@y.org Miller") for i, w in enumerate(["one", "two", "three", "four"])]
    rows += [(20 + i, "Mail copy@copy.org to Trillian") for i in range(4)]
    rows += [(100 + i, f"filler about nothing {i}") for i in range(60)] + [(200, "I saw Zephyr and Miller and Trillian")]
    spans = {r.doc_id: r.spans for r in privacy.find(docs_of(rows)).collect()}
    assert spans[200] == "term:6:12,term:17:23"
    assert "term" not in spans[20]


def test_mixing(spark, docs_of, sample):
    df = docs_of(sample)
    got = mixing.mix(df).collect()
    assert len(got) == len(sample)
    size = collections.Counter()
    for _, text, _, source in sample:
        size[source] += len(WORD.findall(text or ""))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    wanted, target, open_ = 1.5 * sum(size.values()), {}, set(size)
    while True:
        left = wanted - sum(target.values())
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > 2 * size[s]}
        if not over:
            break
        target.update({s: 2.0 * size[s] for s in over})
        open_ -= over
    target.update({s: weight[s] * level for s in open_})
    found = collections.defaultdict(set)
    for r in got:
        found[r.source_size].add(round(r.target, 6))
        assert r.taken in (0, r.size, 2 * r.size)
    assert {x for v in found.values() for x in v} == {round(t, 6) for t in target.values()}
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs_of(sample, parts=5)).collect()))
    rows = mixing.mixed_rows(df)
    assert rows.columns == df.columns
    assert rows.count() == sum(r.taken // r.size for r in got if r.size) + sum(1 for r in got if not r.size) * 0 + rows.where("n_chars = 0").count()


def test_mixing_near_target(spark):
    taken = mixing.op7_mixing(spark, "/root/testdata/sf0.01").groupBy("source_size", "target").agg(F.sum("taken").alias("taken"), F.max("size").alias("largest"))
    for r in taken.collect():
        assert abs(r.taken - r.target) <= r.largest


def test_language(spark, docs_of, sample):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(docs.where(~language.held_out(F.col("doc_id"))))
    right = language.identify(docs.where(language.held_out(F.col("doc_id"))), model).join(docs.select("doc_id", "lang"), "doc_id")
    assert right.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98
    got = by_id(language.identify(docs_of([*sample, (900, "123 !!! 456"), (901, "漢字 かな"), (902, "½ ² ①"), (903, "x²y")]), model))
    assert {r.lang_pred for i in (-1, -2, 900, 902) for r in got[i]} == {"und"}
    assert got[903][0].lang_pred in model.langs
    assert got[901][0].lang_pred in model.langs
    assert all(0 <= r.score <= 1 for v in got.values() for r in v)
    nothing = language.fit(docs.where("false"))
    assert {r.lang_pred for r in language.identify(docs_of(sample), nothing).collect()} == {"und"}


def brute_language(rows, texts, longest, least):
    """The method over plain dictionaries: all documents learned from, every word scored by itself."""
    langs = sorted({lang for _, lang in rows})
    split = lambda text: "".join(c if c.isalpha() else " " for c in text.lower()).split()
    words, grams = collections.Counter(), [collections.Counter() for _ in range(longest)]
    for text, lang in rows:
        for w in split(text):
            words[w, lang] += 1
            for n in range(1, longest + 1):
                grams[n - 1].update((f"^{w}$"[k : k + n], lang) for k in range(len(w) + 3 - n))

    def logs(counts):
        kept = sorted({t for t, _ in counts if sum(counts[t, x] for x in langs) >= least})
        rest = {x: sum(counts[t, x] for t in kept) + 0.5 * len(kept) for x in langs}
        return {t: np.array([np.log((counts[t, x] + 0.5) / rest[x]) for x in langs]) for t in kept}

    known, parts = logs(words), [logs(g) for g in grams]

    def score(w):
        if w in known:
            return known[w]
        for n in range(longest, 0, -1):
            hits = [parts[n - 1][g] for k in range(len(w) + 3 - n) if (g := f"^{w}$"[k : k + n]) in parts[n - 1]]
            if hits:
                return np.mean(hits, axis=0)
        return np.zeros(len(langs))

    for text in texts:
        found = [score(w) for w in split(text or "")]
        if not found:
            yield "und", 0.0
            continue
        total = np.sum(found, axis=0)
        best = int(np.argmax(total))
        yield langs[best], float(1 / np.exp(total - total[best]).sum())


def test_language_equals_brute_force(docs_of, sample):
    some = [r for r in sample[:60] if r[1] and r[2]]
    texts = [(k, r[1]) for k, r in enumerate(some)] + [(200, "zzgh qua neverseen ²x"), (201, "½"), (202, None), (203, "der the la qui " * 3000)]
    model = language.fit(docs_of(some))
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs_of(texts), model).collect()}
    bounds = language.Bounds()
    want = brute_language([(r[1], r[2]) for r in some], [t for _, t in texts], bounds.longest, bounds.min_count)
    for (i, _), (lang, share) in zip(texts, want, strict=True):
        assert got[i][0] == lang and abs(got[i][1] - share) < 1e-9
    assert len(model.langs) > 1


def test_language_model_is_bounded(docs_of, sample):
    rows = [(k, f"{r[1][:300]} wort{k}", f"l{k}") for k, r in enumerate(r for r in sample[:40] if r[1])]
    model = language.fit(docs_of(rows), language.Bounds(max_cells=4000, min_count=1))
    assert len(model.langs) == len(rows)
    assert model.word_logs.size <= 4000 and sum(x.size for x in model.gram_logs) <= 4000


def test_language_backs_off_by_length():
    logs = np.log(np.array([[0.9, 0.1], [0.2, 0.8]]))
    model = language.Model(["x", "y"], {"known": 0}, logs[:1], [{"a": 1}, {"^q": 0}], [logs, logs])
    assert np.allclose(model.backed_off(["qa", "za", "zz"]), [logs[0], logs[1], [0, 0]])
    assert language.score_texts(model, ["known"], {})[0] == ["x"]


def test_toxicity(spark, docs_of, sample):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = language.held_out(F.col("doc_id"))
    model = toxicity.fit(docs.where(~held), labels.where(~held))
    rows = toxicity.score(docs.where(held).join(labels, "doc_id", "left_semi"), model).join(labels, "doc_id").collect()
    y, s = np.array([r.toxic for r in rows]), np.array([r.score for r in rows])
    pairs = (s[y == 1][:, None] > s[y == 0][None, :]).mean() + (s[y == 1][:, None] == s[y == 0][None, :]).mean() / 2
    assert pairs > 0.9
    assert y[s >= 0.5].mean() > 0.8
    got = by_id(toxicity.score(docs_of(sample), model))
    assert all(0 <= r.score <= 1 for v in got.values() for r in v) and got[-1][0].score == got[-2][0].score
    one = toxicity.fit(docs_of([(1, "some text"), (2, None)]), spark.createDataFrame([(1, 0), (2, 0), (3, 1), (None, 1), (2, None)], "doc_id long, toxic int"))
    assert all(0 <= r.score <= 1 for r in toxicity.score(docs_of(sample), one).collect())


def test_toxicity_of_repeated_ids_and_short_words(spark, docs_of):
    """A training does not depend on the order of rows, and words of two letters are evidence."""
    plain = ["the cat sat on a mat", "we go home now then", "rain falls on the hill"]
    rows = [(k, f"{plain[k % 3]} {'zq vx' if k % 2 else 'so it'} {plain[(k + 1) % 3]}") for k in range(40)]
    rows += [(k, f"another text of {k}") for k in range(0, 40, 4)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)] + [(1, 0), (3, None)], "doc_id long, toxic int")
    one = toxicity.fit(docs_of(rows, 1), labels)
    two = toxicity.fit(docs_of(rows[::-1], 7), labels)
    assert (one.ordinary, one.toxic) == (two.ordinary, two.toxic)
    assert b"zq" in one.toxic and b"cat" not in one.toxic and b"zq" not in one.ordinary
    assert np.allclose(one.weights, two.weights) and np.isclose(one.bias, two.bias)


def test_empty_tables(spark, docs_of):
    none = docs_of([])
    assert quality.assess(none).count() == 0 and quality.keep_good(none).columns == none.columns
    assert privacy.find(none).count() == 0 and privacy.sanitise(none).count() == 0
    assert mixing.mix(none).count() == 0 and mixing.mixed_rows(none).count() == 0
    assert language.identify(none, language.fit(none)).count() == 0
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(none, toxicity.fit(none, labels)).count() == 0
