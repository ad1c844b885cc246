"""Chat formatting in budgeted windows.

A conversation becomes windows of whole turns. Prefix sums of the turns' tokens say in which window
a turn is new: the running sum is cut in cells of half the room, a turn belongs to the cell in which
it ends, and a turn longer than a cell stands alone. So the new turns of a window fit the room, and
no turn has to wait for a decision on another one. Each window starts with the system turn, then
repeats the last turns of the window before it up to ``history`` tokens, then has its new turns. Only
new assistant turns are targets: a repeated one is shown and masked. A single turn longer than the
room is kept whole in a window of its own.

Prefix sums are taken within blocks of turns and then over the blocks, and windows are numbered in the
same way, so a conversation that holds most of the rows is not summed in one task.

Nulls: a null text or role is empty; null conversation ids are one conversation; a null turn comes
before all numbers. Rows with equal turns are ordered by role and text, and repeated rows stay repeated. A
conversation of a system turn alone is one window. An empty table gives no window.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payscore.llm.common import table
from payscore.shared import store

# Marks of the template, and strings that other templates give a meaning.
START, END = "<|im_start|>", "<|im_end|>\n"
CONTROL = ["<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]

#: Turns of one block of the prefix sums.
BLOCK = 256
#: The block of turns without a number, which comes before all others.
NO_TURN = -(1 << 62)
#: Tokens that the marks and the role of a turn take.
MARKS = 4


@dataclass(frozen=True)
class Budget:
    """Tokens of a window, and how many of them may repeat what was said before."""

    tokens: int = 1024
    history: int = 256


def _tails() -> str:
    quoted = ["".join("\\" + c if not c.isalnum() else c for c in s[1:]) for s in CONTROL]
    return "|".join(quoted)


def escape(text: Column) -> Column:
    """Put a backslash after the first character of every control string.

    A control string that has backslashes there already gets one more, so taking one away undoes it.
    """
    return F.regexp_replace(text, rf"([<\[])(\\*)({_tails()})", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({_tails()})", "$1$2$3")


def _role_out(role: Column) -> Column:
    """A role in one line."""
    return F.replace(F.replace(escape(role), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def _role_in(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%")))


def tokens_of(text: Column) -> Column:
    """Runs of letters, runs of digits, and single signs."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{M}]+|\p{N}+|[^\s\p{L}\p{M}\p{N}]"))


def _placed(conversations: DataFrame, budget: Budget) -> DataFrame:
    """Every turn with ``_end``, the running sum of tokens up to it without the system turn."""
    text, role = F.coalesce(F.col("text"), F.lit("")), F.coalesce(F.col("role"), F.lit(""))
    block = F.floor(F.col("turn").cast("double") / BLOCK).cast("long")
    block = F.coalesce(block, F.lit(NO_TURN))  # before all others
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), block.alias("block"))
    rows = rows.withColumn("tok", (tokens_of(F.col("text")) + MARKS).cast("long"))
    order = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    rows = store(
        rows.withColumn("inside", F.sum("tok").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("at", F.row_number().over(order))
    ).df
    blocks = rows.groupBy("conv_id", "block").agg(F.sum("tok").alias("held"))
    walk = Window.partitionBy("conv_id").orderBy("block")
    blocks = blocks.withColumn("before", F.sum("held").over(walk) - F.col("held")).withColumn("nth", F.row_number().over(walk))
    first = rows.where("at = 1 AND role = 'system'").select(
        F.col("conv_id").alias("c"), F.col("block").alias("b"), F.struct("turn", "role", "text", "tok").alias("system")
    )
    same = F.col("c").eqNullSafe(F.col("conv_id"))
    heads = blocks.where("nth = 1").join(first, same & (F.col("b") == F.col("block"))).select("c", "system")
    blocks = blocks.select("conv_id", "block", "before", "nth").join(heads, same, "left").drop("c")
    blocks = blocks.withColumnsRenamed({"conv_id": "c", "block": "b"})
    placed = rows.join(blocks, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))).drop("c", "b")
    is_system = F.col("system").isNotNull() & (F.col("nth") == 1) & (F.col("at") == 1)
    system_tok = F.coalesce(F.col("system.tok"), F.lit(0))
    cell = F.greatest(F.floor((F.lit(budget.tokens - budget.history) - system_tok) / 2), F.lit(1))
    return store(
        placed.select(
            "conv_id", "turn", "role", "text", "tok", "system", is_system.alias("is_system"), cell.alias("cell"),
            (F.col("before") + F.col("inside") - system_tok).alias("_end"),
        )
    ).df


def _numbered(spans: DataFrame) -> DataFrame:
    """Adds ``window``, the number of a span in its conversation, and ``last``; within blocks, then over the blocks."""
    spans = spans.withColumn("block", F.floor(F.col("span") / (2 * BLOCK)))
    inside = F.row_number().over(Window.partitionBy("conv_id", "block").orderBy("span"))
    spans = store(spans.withColumn("inside", inside)).df
    blocks = spans.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("held"))
    whole = Window.partitionBy("conv_id")
    before = F.sum("held").over(whole.orderBy("block")) - F.col("held")
    blocks = blocks.withColumn("before", before).withColumn("all", F.sum("held").over(whole))
    blocks = blocks.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), "before", "all")
    at = F.col("before") + F.col("inside")
    return spans.join(blocks, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))).select(
        "conv_id", "span", "upto", (at - 1).cast("int").alias("window"), (at == F.col("all")).alias("last")
    )


def chat_windows(conversations: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """conv_id, window (from 0), text, n_repeated (leading turns shown before), loss (spans of targets)."""
    rows = _placed(conversations, budget)
    said = rows.where(~F.col("is_system"))
    span = F.floor((F.col("_end") - 1) / F.col("cell")) * 2 + F.when(F.col("tok") > F.col("cell"), 0).otherwise(1)
    said = said.withColumn("span", span)
    spans = store(_numbered(said.groupBy("conv_id", "span").agg(F.max("_end").alias("upto")))).df
    keys = spans.withColumnsRenamed({"conv_id": "c", "span": "s"})
    here = F.col("conv_id").eqNullSafe(F.col("c"))
    said = said.join(keys, here & (F.col("span") == F.col("s")))
    near = ~F.col("last") & (F.col("upto") - F.col("_end") + F.col("tok") <= budget.history)
    shown = F.when(near, F.array(F.lit(2), F.lit(1))).otherwise(F.array(F.lit(2)))
    said = said.withColumn("part", F.explode(shown)).select(
        "conv_id", (F.col("window") + F.when(F.col("part") == 1, 1).otherwise(0)).alias("window"),
        F.struct("part", F.col("_end").alias("place"), "turn", "role", "text").alias("t"),
    )
    heads = rows.where("is_system").select("conv_id", "turn", "role", "text")
    heads = heads.join(keys.select("c", "window"), here, "left").select(
        "conv_id", F.coalesce("window", F.lit(0)).alias("window"),
        F.struct(F.lit(0).alias("part"), F.lit(0).cast("long").alias("place"), "turn", "role", "text").alias("t"),
    )
    # A window holds few turns: it is bounded by the budget.
    made = said.unionByName(heads).groupBy("conv_id", "window").agg(F.sort_array(F.collect_list("t")).alias("t"))
    made = made.withColumn("head", F.transform("t", lambda t: F.concat(F.lit(START), _role_out(t["role"]), F.lit("\n"))))
    made = made.withColumn("body", F.transform("t", lambda t: escape(t["text"])))
    repeated = F.size(F.filter("t", lambda t: (t["part"] == 1) | ((t["part"] == 0) & (F.col("window") > 0))))
    target = F.transform("t", lambda t: (t["part"] == 2) & (t["role"] == "assistant"))
    sizes = F.zip_with(
        F.zip_with("head", "body", lambda h, b: F.struct(F.char_length(h).alias("h"), F.char_length(b).alias("b"))),
        "target", lambda x, y: F.struct(x["h"].alias("h"), x["b"].alias("b"), y.alias("on")),
    )
    made = made.withColumn("target", target).withColumn("sizes", sizes)
    none = F.array().cast("array<struct<start:int,end:int>>")

    def walk_on(a: Column, x: Column) -> Column:
        start = a["at"] + x["h"]
        one = F.array(F.struct(start.alias("start"), (start + x["b"]).alias("end")))
        return F.struct((start + x["b"] + len(END)).alias("at"), F.when(x["on"], F.concat(a["spans"], one)).otherwise(a["spans"]).alias("spans"))

    loss = F.aggregate("sizes", F.struct(F.lit(0).alias("at"), none.alias("spans")), walk_on)["spans"]
    text = F.array_join(F.zip_with("head", "body", lambda h, b: F.concat(h, b, F.lit(END))), "")
    return made.select("conv_id", "window", text.alias("text"), repeated.alias("n_repeated"), loss.alias("loss"))


def read_turns(text: Column) -> Column:
    """The turns of a formatted window, as structs of role and text."""
    parts = F.split(text, r"<\|im_end\|>\n")
    body = F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda p: F.substring(p, F.lit(len(START) + 1), F.char_length(p)))
    role = lambda b: F.substring_index(b, "\n", 1)
    return F.transform(
        body,
        lambda b: F.struct(
            _role_in(role(b)).alias("role"),
            unescape(F.substring(b, F.char_length(role(b)) + 2, F.char_length(b))).alias("text"),
        ),
    )


def read_loss(text: Column, loss: Column) -> Column:
    """All text under the loss mask of a window, as it was before it was escaped."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(text, s["start"] + 1, s["end"] - s["start"]))), "")


def op1_chat(spark, sf_dir: str) -> DataFrame:
    """Digests of all conversations, read back from their windows.

    The digest of a conversation is one hash over all of its text, so here, and only here, its
    windows come together in one row.
    """
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.sql("SELECT * FROM VALUES (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), (-1L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)")
    windows = chat_windows(given.unionByName(extra))
    turns = read_turns(F.col("text"))
    windows = windows.withColumn("turns", turns).withColumn("new", F.slice("turns", F.col("n_repeated") + 1, F.size("turns")))
    told = F.array_join(F.transform("new", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    part = F.struct(
        "window", told.alias("told"), read_loss(F.col("text"), F.col("loss")).alias("loss"),
        F.size("new").alias("n"), F.char_length("text").alias("chars"),
    )
    parts = windows.groupBy("conv_id").agg(F.sort_array(F.collect_list(part)).alias("p"))
    total = lambda name: F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x[name])
    text = lambda name: F.array_join(F.transform("p", lambda x: x[name]), "")
    return parts.select(
        "conv_id", total("n").alias("n_turns"), F.sha2(text("told"), 256).alias("turns_sha256"),
        F.char_length(text("loss")).cast("long").alias("loss_chars"), F.sha2(text("loss"), 256).alias("loss_sha256"),
        total("chars").alias("formatted_chars"), F.size("p").cast("long").alias("n_windows"),
    )
