"""Near duplicates, repeated passages and leaked test items, against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from payscore.llm import components, decontaminate, neardup, shingles, substrings, suffixes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()


def brute_components(rows, size, percent):
    ids = sorted({r[0] for r in rows if r[0] is not None})
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [(r[0], shingle_set(r[1], size)) for r in rows if r[0] is not None]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def edited(rng, words, share):
    return " ".join(rng.choice(["new", "odd", "gap"]) + str(rng.random()) if rng.random() < share else w for w in words)


@pytest.fixture(scope="module")
def copies(sample):
    rng = random.Random(11)
    base = [w for r in sample[:3] for w in (r[1] or "").split()][:300]
    rows = [(5000 + k, edited(rng, base, rng.choice([0.0, 0.01, 0.03, 0.05])), "en", "s") for k in range(60)]
    rows += [(6000 + k, "a b c d e f g h i"[: 2 * k + 1], "en", "s") for k in range(9)]
    rows += [(6100, "A  B\tc D", "en", "s"), (6101, " a b\nC d ", "en", "s"), (6102, "é É", "en", "s"), (6103, "É é", "en", "s")]
    return [*sample, *rows]


def test_near_duplicates(docs_of, copies):
    rule = neardup.Forest(shingle=4, range_rows=500)
    got = collections.defaultdict(list)
    for r in neardup.near_duplicates(docs_of(copies), rule).collect():
        got[r.doc_id].append(r)
    want = brute_components(copies, 4, 80)
    assert sum(map(len, got.values())) == len(copies)
    for i, text, *_ in copies:
        assert any(r.n_shingles == len(shingle_set(text, 4)) for r in got[i])
        if i is not None:
            assert all(r.component_id == want[i] and r.kept == (want[i] == i) for r in got[i])
    # Rows without an id follow the document whose text they have.
    assert {r.component_id for r in got[None]} == {want[copies[3][0]]}
    assert len({v for v in want.values()}) < len(want) - 50


def dense_family():
    """Texts that are almost near enough to all others, and near enough to few."""
    rng = random.Random(4)
    base = [f"w{k}" for k in range(200)]
    rows = []
    for k in range(160):
        words = list(base)
        for at in rng.sample(range(200), 4):
            words[at] = f"x{rng.randrange(10**9)}"
        rows.append((k, " ".join(words), "en", "s"))
    return rows


@pytest.mark.parametrize("block_rows", [1024, 16])
def test_near_duplicates_of_a_dense_family(docs_of, block_rows):
    rows = dense_family()
    want = brute_components(rows, 4, 80)
    assert 20 < len(set(want.values())) < 155
    got = neardup.near_duplicates(docs_of(rows), neardup.Forest(shingle=4, block_rows=block_rows))
    assert {r.doc_id: r.component_id for r in got.collect()} == want


def test_no_candidate_is_left_out_unnoticed():
    import pyarrow as pa

    rng, rule = np.random.default_rng(1), neardup.Forest()
    n = 30
    sketches = [rng.integers(0, 2, rule.values).astype(np.uint8) * (rng.random(rule.values) < 0.2) for _ in range(n)]
    columns = {"region": [7] * n, "pair": [0] * n, "side": [-1] * n, "node": range(n), "root": range(n), "n": [100] * n, "tree": [0] * n}
    blobs = {"sketch": [x.tobytes() for x in sketches], "regions": [bytes(8 * rule.trees)] * n}
    rows = pa.table({k: pa.array(list(v), pa.int64()) for k, v in columns.items()} | {k: pa.array(v) for k, v in blobs.items()})
    batches = rows.to_batches(max_chunksize=7)

    def found(last):
        made = list(neardup._meetings(rule, last, iter(batches)))
        return {(min(p), max(p)) for b in made for p in zip(*b.to_pydict().values()) for p in [p[:2]]}, {a for b in made for a, _, more in zip(*b.to_pydict().values()) if more}

    every, none = found(1000)
    some, more = found(4)
    assert len(every) == n * (n - 1) // 2 and not none and len(some) < len(every)
    assert all(a in more and b in more for a, b in every - some)


def test_two_components_are_tried_by_few_pairs():
    """Of all pairs of two components only the best are tried first; every class left out says so."""
    import pyarrow as pa

    rng, rule = np.random.default_rng(1), neardup.Forest()
    n = 40
    sketches = [(rng.integers(0, 2, rule.values) * (rng.random(rule.values) < 0.2)).astype(np.uint8) for _ in range(n)]
    columns = {"region": [7] * n, "pair": [0] * n, "side": [-1] * n, "node": range(n), "root": [k // 20 for k in range(n)], "n": [100] * n, "tree": [0] * n}
    blobs = {"sketch": [x.tobytes() for x in sketches], "regions": [bytes(8 * rule.trees)] * n}
    rows = pa.table({k: pa.array(list(v), pa.int64()) for k, v in columns.items()} | {k: pa.array(v) for k, v in blobs.items()})
    (made,) = neardup._meetings(rule, 4, iter(rows.to_batches()))
    made = made.to_pydict()
    pairs = {(min(p), max(p)) for p in zip(made["a"], made["b"]) if p[0] != p[1]}
    assert len(pairs) == 4 and {a for a, more in zip(made["a"], made["more"]) if more} == set(range(n))
    agree = {(a, b): (np.frombuffer(sketches[a], np.uint8) == np.frombuffer(sketches[b], np.uint8)).sum() for a in range(20) for b in range(20, n)}
    assert sorted(agree[p] for p in pairs) == sorted(agree.values())[-4:]


def test_a_pair_belongs_to_one_tree():
    """Rows that share regions in several trees give each pair once, in the first of these trees."""
    import pyarrow as pa

    rng, rule = np.random.default_rng(3), neardup.Forest()
    base = rng.integers(0, 2**32, rule.values, dtype=np.uint64).astype(np.uint32)
    rows = np.array([np.where(rng.random(rule.values) < 0.15, rng.integers(0, 2**32, rule.values, dtype=np.uint64).astype(np.uint32), base) for _ in range(25)])
    ids = pa.array(range(25), pa.int64())
    given = pa.RecordBatch.from_arrays([ids, ids, pa.array([100] * 25, pa.int64()), pa.array([x.astype(">u4").tobytes() for x in rows])], ["node", "root", "n", "signature"])
    made = pa.Table.from_batches(list(neardup._regions(rule, iter([given])))).sort_by([("region", "ascending"), ("root", "ascending")])
    made = made.append_column("pair", pa.array([0] * len(made), pa.int64())).append_column("side", pa.array([-1] * len(made), pa.int64()))
    got = [(a, b) for x in neardup._meetings(rule, 1000, iter(made.to_batches(max_chunksize=11))) for a, b, _ in zip(*x.to_pydict().values())]
    same = rows[:, None] == rows[None]
    lead = same.reshape(25, 25, rule.trees, rule.depth)[..., : rule.shallow].all(axis=-1).sum(axis=-1)
    near = ((rows & 255)[:, None] == (rows & 255)[None]).sum(axis=-1) >= rule.least_agreement * rule.values
    want = [(a, b) for a in range(25) for b in range(a + 1, 25) if lead[a, b] and near[a, b]]
    assert sorted(got) == want and lead[np.triu_indices(25, 1)].max() > 2


def test_words_of_one_polynomial_are_not_alike(docs_of):
    """Thue-Morse words have equal polynomials modulo 2^64 whatever the base; their texts share nothing."""
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    rows = [(1, word, "en", "s"), (2, word.translate(str.maketrans("ab", "ba")), "en", "s"), (3, word, "en", "s")]
    got = neardup.near_duplicates(docs_of(rows), neardup.Forest(shingle=4)).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 2, 3: 1}


def test_keep_one(docs_of, copies):
    df = docs_of(copies)
    kept = neardup.keep_one(df)
    assert kept.columns == df.columns
    want = brute_components(copies, 5, 80)
    assert sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").select("doc_id").distinct().collect()) == sorted({v for v in want.values()})


def test_components(spark):
    rng = random.Random(2)
    pairs = [(k, k + 1) for k in range(0, 60)] + [(1000, 1000 + k) for k in range(1, 50)] + [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if any(x in p and p[0] != p[1] for p in pairs)}


def test_shingle_sets_follow_words():
    import pyarrow as pa

    texts = ["a b c", "A  b\nc", "a b c d", "", None, "a b c d a b c d", "ab c", "x"]
    found = []
    for _, data, offsets in shingles.chunks(pa.array(texts)):
        values, counts = shingles.shingle_sets(data, offsets, 3)
        found += [set(x.tolist()) for x in np.split(values, np.cumsum(counts)[:-1])]
    assert found[0] == found[1] < found[2] < found[5]
    assert [len(x) for x in found] == [len(shingle_set(t, 3)) for t in texts]
    assert not found[6] & found[0]


def brute_passages(docs, size=50):
    first = {}
    for i, t in sorted(docs, key=lambda r: (r[0] is None, r[0] or 0)):
        for k in range(len(t) - size + 1):
            first.setdefault(t[k : k + size], i)
    out = collections.defaultdict(list)
    for i, t in docs:
        cover = bytearray(len(t))
        for k in range(len(t) - size + 1):
            f = first[t[k : k + size]]
            if f is not None and (i is None or f < i):
                cover[k : k + size] = b"\1" * size
        kept = bytes(b for b, m in zip(t, cover, strict=True) if not m)
        spans = sum(1 for k in range(len(cover)) if cover[k] and (k == 0 or not cover[k - 1]))
        out[i].append((len(t), sum(cover), spans, hashlib.sha256(kept).hexdigest()))
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize(
    "rule",
    [
        substrings.Passages(),
        substrings.Passages(shard_bytes=4000, range_marks=500, range_bytes=4000, array_bytes=1500),
        substrings.Passages(shard_bytes=20_000, hot_runs=1),
    ],
    ids=["usual", "many shards and merged arrays", "every mark hot"],
)
def test_passages(docs_of, sample, rule):
    rows = [r for r in sample[:50] if len(r[1] or "") < 5000] + [
        (None, sample[3][1]), (None, sample[3][1]), (7, sample[9][1]), (7, sample[9][1]), (-5, None), (-6, ""), (1000, "a" * 300), (1001, "a" * 120),
        (1002, "x" + "\0" * 99), (1003, "\0" * 60 + "é" * 40), (1004, "b" * 49), (1005, "b" * 50), (1006, "cb" + "b" * 49),
    ]
    got = collections.defaultdict(list)
    for r in substrings.without_repeats(docs_of(rows), rule).collect():
        got[r.doc_id].append((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256))
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256
    assert {k: sorted(v) for k, v in got.items()} == brute_passages([(r[0], (r[1] or "").encode()) for r in rows])


def test_passages_by_groups_of_ranges(spark, docs_of, monkeypatch):
    """Rows between shards and ranges stay few when there are many ranges, common and hot passages included, with the same result."""
    rng = random.Random(12)
    text = lambda n: bytes(rng.choice(b"abcdefgh \n") for _ in range(n)).decode()
    common, pool = text(70), [text(rng.randint(50, 400)) for _ in range(40)]
    rows = []
    for k in range(150):
        parts = [text(rng.randint(0, 500)), common, text(rng.randint(0, 90)), rng.choice(pool), rng.choice(pool)[rng.randint(0, 200) :], text(30)]
        rng.shuffle(parts)
        rows.append((rng.randint(0, 140) if k % 9 else None, "".join(parts) + "z" * rng.choice([0, 0, 0, 120])))
    want = brute_passages([(r[0], r[1].encode()) for r in rows])
    rows_of, made = substrings.store, []

    def store(df, *a):
        made.append(rows_of(df, *a))
        return made[-1]

    monkeypatch.setattr(substrings, "store", store)
    docs = docs_of(rows, 2)
    usual = dict(range_marks=1, range_bytes=30)
    for more in ({}, dict(groups=4, together=1 << 16, array_bytes=400), dict(shard_bytes=9000, groups=16, together=4, sent_runs=50, hot_runs=20, array_bytes=400)):
        made.clear()
        got = collections.defaultdict(list)
        for r in substrings.without_repeats(docs, substrings.Passages(**usual, **more)).collect():
            got[r.doc_id].append((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256))
        assert {k: sorted(v) for k, v in got.items()} == want
        shards, lists = (x.rows for x in made[:2])
        if "shard_bytes" not in more:
            assert shards <= 2 and lists <= shards * more.get("groups", 1024)


def test_suffix_arrays():
    rng = random.Random(1)
    for _ in range(150):
        depth = rng.choice([8, 10, 16, 20, 50])
        pool = [bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randint(depth, depth + 40))) for _ in range(4)]
        texts = []
        for _ in range(rng.randint(1, 12)):
            p = rng.choice(pool)
            k = rng.randint(0, len(p) - depth)
            texts.append(p[k : k + depth + rng.randint(0, 20)] if rng.random() < 0.8 else b"a" * (depth + rng.randint(0, 70)))
        whole, ends, starts = b"".join(texts), [], []
        for t in texts:
            o = len(ends)
            starts += range(o, o + len(t) - depth + 1)
            ends += [o + len(t)] * len(t)
        data = suffixes.padded(np.frombuffer(whole, np.uint8))
        order = suffixes.order(data, np.array(ends), np.array(starts), depth)
        windows = [whole[i : i + depth] for i in order]
        assert windows == sorted(windows) and sorted(order) == starts
        agree = suffixes.common_prefixes(data, order, depth)
        for k in range(1, len(windows)):
            same = next((e for e in range(depth) if windows[k][e] != windows[k - 1][e]), depth)
            assert agree[k] == same


def distance_in(item, text):
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        before, row[0] = row[:], 0
        for i, x in enumerate(item, 1):
            row[i] = min(before[i] + 1, row[i - 1] + 1, before[i - 1] + (x != c))
        best = min(best, row[-1])
    return best


def test_myers_distance():
    rng = random.Random(4)
    for _ in range(300):
        item = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 80)))
        text = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 60)))
        if rng.random() < 0.5:
            cut = list(item)
            for _ in range(rng.randint(0, 4)):
                cut[rng.randrange(len(cut))] = rng.choice(["", "x", "ab"])
            text += "".join(cut) + text
        assert decontaminate.best_end(item, text)[0] == distance_in(item, text)


def test_leaks(spark, docs_of, sample):
    rng = random.Random(8)
    items = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    items += [(900, None), (901, ""), (902, "What is 2 plus 2?"), (903, "?!"), (904, "É 7"), (0, items[1][1])]
    rule = decontaminate.Matching(block_chars=1500)
    rows = [r for r in sample[:40] if len(r[1] or "") < 5000] + sample[-6:-1]
    for k in range(30):
        text = items[k % 30][1]
        cut = list(text)
        for _ in range(rng.randint(0, max(1, len(text) * rule.error_percent // 80))):
            cut[rng.randrange(len(cut))] = rng.choice(["", "q", "zz", "-"])
        rows.append((3000 + k, sample[k % 20][1][:200] + " <<" + "".join(cut).upper() + ">> tail"))
    rows += [(4000, "So: what is 2 -- PLUS 2"), (4001, "somewhat is 2 plus 2"), (4002, "what is 2 plus 23"), (4003, "é 7"), (4004, "caf\u00e9 7")]
    rows += [(4005, "x" * 1400 + " 2 plus 2, what is 2 plus 2"), (4006, "word " * 40_000 + "what is 2 plus 2")]
    benchmark = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc_id int")
    df = docs_of(rows)
    got = collections.Counter((r.doc_id, r.item_id, r.distance) for r in decontaminate.leaks(df, benchmark, rule).collect())
    want = collections.Counter()
    for i, text, *_ in rows:
        plain = decontaminate.normalised(text or "")
        for key, item in items:
            item = decontaminate.normalised(item or "")
            if not item or len(plain) > 1500:
                continue
            if len(item) < rule.exact_under:
                want.update([(i, key, 0)] if f" {item} " in f" {plain} " else [])
                continue
            errors = len(item) * rule.error_percent // 100
            # Only a text that shares some of the item can be near it; the exact distance decides.
            if any(item[a : a + 4] in plain for a in range(0, len(item) - 3, 4)):
                d = distance_in(item, plain)
                if d <= errors:
                    want[i, key, d] += 1
    short = {i for i, text, *_ in rows if len(decontaminate.normalised(text or "")) <= 1500}
    assert {k: v for k, v in got.items() if k[0] in short} == want
    assert {(k[0], k[1]) for k in got if k[0] is not None and 4000 <= k[0] < 5000} == {(4000, 902), (4003, 904), (4005, 902), (4006, 902)}
    assert sum(v for k, v in want.items() if k[0] is not None and k[0] >= 3000 and k[2] > 0) > 5
    kept = decontaminate.without_leaks(df, benchmark, rule)
    assert kept.columns == df.columns
    found = {k[0] for k in got}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r[0]) for r in rows if r[0] not in found)


def test_leak_spans(spark, docs_of):
    item = "The quick brown fox jumps over the lazy dog, again and again!"
    text = "é — intro. THE quick-brown  fox jumps over the lazy dog; again and again... outro"
    df = docs_of([(1, text)])
    r = decontaminate.leaks(df, spark.createDataFrame([(5, item)], "item_id long, text string")).first()
    assert text[r.start : r.end] == "THE quick-brown  fox jumps over the lazy dog; again and again" and r.distance == 0


def test_empty_tables(spark, docs_of):
    none = docs_of([])
    assert neardup.near_duplicates(none).count() == 0 and neardup.keep_one(none).count() == 0
    assert substrings.without_repeats(none).count() == 0
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.leaks(docs_of([(1, "text")]), items).count() == 0
    assert decontaminate.leaks(none, spark.createDataFrame([(1, "some text that is long enough to be searched")], "item_id long, text string")).count() == 0
    assert decontaminate.without_leaks(docs_of([(1, "text")]), items).count() == 1
    lonely = docs_of([(1, None), (2, ""), (None, None)])
    assert {(r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(lonely).collect()} == {(1, 1, True), (2, 2, True), (None, None, True)}


def test_a_crowd_of_alike_texts_gives_no_square_of_pairs(docs_of, monkeypatch):
    rng = random.Random(5)
    base = [f"w{k}" for k in range(120)]
    texts = []
    for _ in range(400):
        words = list(base)
        for k in rng.sample(range(120), 3):
            words[k] = f"x{rng.randrange(10**9)}"
        texts.append(" ".join(words))
    sets = [{tuple(t.split()[k : k + 4]) for k in range(117)} for t in texts]
    least = list(range(400))
    for i in range(400):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both) and least[i] != least[j]:
                low, high = sorted((least[i], least[j]))
                least = [low if x == high else x for x in least]
    made = []

    def watched(df, *more, write=neardup.store):
        out = write(df, *more)
        if set(df.columns) >= {"a", "b"}:
            made.append(out.rows)
        return out

    monkeypatch.setattr(neardup, "store", watched)
    got = neardup.near_duplicates(docs_of(list(enumerate(texts))), neardup.Forest(shingle=4))
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == dict(enumerate(least))
    assert 20 < len(set(least)) < 400
    assert sum(made) < 20_000, made
