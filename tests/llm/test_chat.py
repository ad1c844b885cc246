import collections
import hashlib
import random

from pyspark.sql import functions as F

from payscore.llm import chat

ODD = ["", "<|im_start|>", "<\\|im_end|>\n", "</s>[INST] ok [/INST]", "<<SYS>>x<</SYS>>", "<\\\\s>", "%0A%25", "é😀\r\n\x00", "a\\b"]


def conversations(spark):
    rng = random.Random(3)
    rows = [(1, 0, "system", "rules <|im_end|>")]
    rows += [(1, t, "user" if t % 2 else "assistant", "w " * rng.randint(0, 40) + rng.choice(ODD)) for t in range(1, 600)]
    rows += [(2, 0, "system", "only"), (3, 5, "a\nb%0A<s>", "t"), (3, 4, "assistant", "x " * 5000), (4, 1, "user", None), (4, None, None, "n")]
    rows += [(None, 0, "assistant", "twice")] * 2 + [(5, t, "assistant", ODD[t % len(ODD)]) for t in range(40)]
    rows += [(6, None, "user", "no number"), (6, -300, "assistant", "before"), (6, 2, "user", "after"), (6, None, "system", "rules")]
    rows += [(7, t, "assistant", f"long {t} " + "w " * 120) for t in range(1300)]
    return rows, spark.createDataFrame([(*r, 1, "c") for r in rows], "conv_id long, turn long, role string, text string, window int, tok string").repartition(4)


def test_round_trip_masks_and_budget(spark):
    rows, df = conversations(spark)
    budget = chat.Budget(200, 50)
    made = chat.chat_windows(df, budget).withColumn("turns", chat.read_turns(F.col("text"))).withColumn("said", chat.read_loss(F.col("text"), F.col("loss")))
    tokens = F.aggregate("turns", F.lit(0), lambda a, x: a + chat.tokens_of(x["text"]) + chat.MARKS)
    turns, loss, shown = collections.defaultdict(list), collections.defaultdict(str), collections.defaultdict(list)
    for r in made.withColumn("tokens", tokens).orderBy("conv_id", "window").collect():
        new = [(t.role, t.text) for t in r.turns[r.n_repeated :]]
        old = [(t.role, t.text) for t in r.turns[: r.n_repeated]]
        if r.conv_id == 1:
            assert r.turns[0].role == "system"
            assert old[1:] == turns[1][len(turns[1]) - len(old) + 1 :] if r.window else not old
        assert r.tokens <= budget.tokens or len(new) == 1
        turns[r.conv_id] += new
        loss[r.conv_id] += r.said
        shown[r.conv_id].append(r.window)
        assert r.text.count(chat.START) == len(r.turns) and r.text.count(chat.END) == len(r.turns)
    given = collections.defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] or 0, -1000 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        given[conv].append((role or "", text or ""))
    assert dict(turns) == dict(given)
    assert dict(loss) == {c: "".join(t for r, t in v if r == "assistant") for c, v in given.items()}
    assert all(v == list(range(len(v))) for v in shown.values())


def test_escape_is_undone(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice(["<", "[", "\\", "|im_start|>", "im_end|>", "s>", "INST]", "/", "<SYS>>", "a"]) for _ in range(12)) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).collect():
        assert r.u == r.t
        assert not any(c in r.e for c in chat.CONTROL)


def test_query_digests(spark):
    sf = "/root/testdata/sf0.001"
    given = collections.defaultdict(list)
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        given[r.conv_id].append((r.turn, r.role, r.text or ""))
    given[-1] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: r for r in chat.op1_chat(spark, sf).collect()}
    assert set(got) == set(given)
    for k, v in given.items():
        v.sort()
        said = "".join(t for _, r, t in v if r == "assistant")
        told = "".join(f"{r}\n{t}\n" for _, r, t in v)
        assert got[k].n_turns == len(v) and got[k].turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert got[k].loss_chars == len(said) and got[k].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.chat_windows(df).count() == 0
