"""Conversations as training windows of bounded size, with a loss mask. Built-in functions only.

Prefix sums of the turns' tokens choose the windows. A conversation's span is what the budget leaves beside the
system turn and the history. A turn belongs to the window of the span its first token falls into; a turn that
reaches beyond that span is a window of its own. So windows end at turns, no window is longer than the
budget unless one turn or the system turn alone takes more than its share, and no window waits for the one before it.
Each window begins with the conversation's system turn (a first turn of that role), then repeats the turns
that end the history, as many whole ones as ``HISTORY`` tokens hold, then has its own turns. Loss is on the texts of
its own assistant turns; repeated ones are masked, so each target counts once.

Prefix sums are taken in two steps, within blocks of turn numbers and then over blocks, and a window is at most one
budget long, so a conversation that holds a third of all rows is no single task's work. Equal rows are counted
before they are moved, and spread out again afterwards.

The template marks a turn as ``<|role|>``, line end, text, ``</s>``, line end, after ``<s>``. In texts, a control
string gets a backslash after its first character, and one that has backslashes there gets one more; taking one out
reads it back. Roles are escaped likewise by letters.

Defined cases. A null text or role is empty. Rows are taken by turn, then role, then text, nulls first; equal rows
stay. A null conv_id is one conversation. An empty table gives no windows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from carelens.llm.store import stored

#: Tokens of a window, of repeated history, of the marks of a turn; least tokens of a span.
BUDGET, HISTORY, TURN_MARKS, LEAST_SPAN = 2048, 512, 4, 512
#: Turn numbers per block of the first prefix sum.
BLOCK_TURNS = 1024
SYSTEM, TARGET = "system", "assistant"

# The template, the strings that control a model, and what counts as a token.
BEGIN, TURN_END = "<s>", "</s>\n"
CONTROL = r"(\||/s>|s>|/?INST\])"
TOKEN = r"[A-Za-z0-9]+|[^A-Za-z0-9\x09-\x0D\x20]"
ROLE_ESCAPES = (("\\", r"\e"), ("|", r"\p"), ("<", r"\l"), ("[", r"\b"))


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + CONTROL, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + CONTROL, "$1$2$3")


def escaped_role(role: Column) -> Column:
    for plain, code in ROLE_ESCAPES:
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def unescaped_role(role: Column) -> Column:
    for plain, code in reversed(ROLE_ESCAPES):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def turn_head(role: Column) -> Column:
    return F.concat(F.lit("<|"), escaped_role(role), F.lit("|>\n"))


#: A conversation's key without nulls, so that windows, aggregates and joins on it share a partitioning.
KEY = ["no_id", "id"]


def numbered(conversations: DataFrame) -> DataFrame:
    """The key, ordinal, role, text, tokens and tokens before of each turn, and its conversation's system turn."""
    kind = conversations.schema["conv_id"].dataType
    no_id, id_ = F.col("conv_id").isNull(), F.coalesce("conv_id", F.lit("0").cast(kind))
    role, text = F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    turns = conversations.select(no_id.alias("no_id"), id_.alias("id"), "turn", role, text)
    turns = turns.groupBy(*KEY, "turn", "role", "text").agg(F.count("*").alias("copies"))
    tokens = (F.regexp_count("text", F.lit(TOKEN)) + TURN_MARKS).cast("long")
    # Turns without a number come first.
    block = F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(-(1 << 62)))
    turns = turns.withColumns({"tokens": tokens, "block": block})

    inside = W.partitionBy(*KEY, "block").orderBy("turn", "role", "text").rowsBetween(W.unboundedPreceding, -1)
    size = F.col("tokens") * F.col("copies")
    turns = turns.withColumns(
        {
            "tokens_inside": F.coalesce(F.sum(size).over(inside), F.lit(0)),
            "turns_inside": F.coalesce(F.sum("copies").over(inside), F.lit(0)),
        }
    )
    opening = (F.col("turns_inside") == 0) & (F.col("role") == SYSTEM)
    blocks = turns.groupBy(*KEY, "block").agg(
        F.sum(size).alias("block_tokens"),
        F.sum("copies").alias("block_turns"),
        F.max(F.when(opening, F.col("text"))).alias("opening"),
        F.max(F.when(opening, F.col("tokens"))).alias("opening_tokens"),
    )
    in_order = W.partitionBy(*KEY).orderBy("block")
    earlier = in_order.rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.select(
        *KEY,
        "block",
        F.coalesce(F.sum("block_tokens").over(earlier), F.lit(0)).alias("tokens_before_block"),
        F.coalesce(F.sum("block_turns").over(earlier), F.lit(0)).alias("turns_before_block"),
        F.first("opening").over(in_order).alias("system"),
        F.first("opening_tokens").over(in_order).alias("system_tokens"),
    )
    placed = turns.join(blocks, [*KEY, "block"])
    placed = placed.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    return placed.select(
        *KEY,
        (F.col("turns_before_block") + F.col("turns_inside") + F.col("copy")).alias("ordinal"),
        "role",
        "text",
        "tokens",
        (F.col("tokens_before_block") + F.col("tokens_inside") + F.col("copy") * F.col("tokens")).alias("before"),
        "system",
        "system_tokens",
    )


def windows(
    conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, least_span: int = LEAST_SPAN
) -> DataFrame:
    """conv_id, window, text, tokens and spans, an array of (begin, end, repeated, loss), one per turn in the text.

    ``begin`` and ``end`` are code points of the escaped text of the turn. ``history`` must not exceed ``least_span``.
    """
    if history > least_span:
        raise ValueError("history must fit into a span")
    turns = numbered(conversations)
    is_system = (F.col("ordinal") == 0) & (F.col("role") == SYSTEM)
    span = F.greatest(F.lit(budget - history) - F.coalesce("system_tokens", F.lit(0)), F.lit(least_span)).cast("long")
    turns = turns.withColumn("span", span).withColumn("number", F.expr("before div span"))
    over = (F.col("before") % F.col("span") > 0) & (F.col("before") + F.col("tokens") > (F.col("number") + 1) * F.col("span"))
    turns = stored(turns.withColumn("window", F.col("number") * 2 + over.cast("long")), "turns")

    starts = turns.groupBy(*KEY, "window").agg(
        F.min("before").alias("start"),
        F.min("ordinal").alias("first"),
        F.max("system").alias("system"),
        F.max("system_tokens").alias("system_tokens"),
    )
    row = (*KEY, "window", "ordinal", "role", "text", "tokens", "repeated")
    own = turns.withColumn("repeated", F.lit(False)).select(*row)
    again = starts.where("first > 0 and system is not null").select(
        *KEY, "window", F.lit(0).cast("long").alias("ordinal"), F.lit(SYSTEM).alias("role"), F.col("system").alias("text"),
        F.col("system_tokens").alias("tokens"), F.lit(True).alias("repeated"),
    )
    # A turn can be history of windows that begin less than ``history`` tokens after it does.
    last = F.expr(f"(before + {history}) div span") * 2 + 1
    later = turns.where(last > F.col("window")).where(~is_system)
    later = later.withColumn("window", F.explode(F.sequence(F.col("window") + 1, last)))
    past = later.join(starts.select(*KEY, "window", "start"), [*KEY, "window"])
    past = past.where(F.col("start") - F.col("before") <= history).withColumn("repeated", F.lit(True)).select(*row)

    parts = own.unionByName(again).unionByName(past)
    turn = F.struct("ordinal", "repeated", turn_head(F.col("role")).alias("head"), escaped(F.col("text")).alias("body"), "role", "tokens")
    held = parts.groupBy(*KEY, "window").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    text = F.concat(
        F.lit(BEGIN), F.array_join(F.transform("turns", lambda x: F.concat(x["head"], x["body"], F.lit(TURN_END))), "")
    )
    conv_id = F.when(~F.col("no_id"), F.col("id")).alias("conv_id")
    return held.select(conv_id, "window", text.alias("text"), _tokens().alias("tokens"), _spans().alias("spans"))


def _tokens() -> Column:
    return F.aggregate("turns", F.lit(0).cast("long"), lambda total, x: total + x["tokens"])


def _spans() -> Column:
    """Where each turn's text stands, by adding up what comes before it."""

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + F.char_length(x["head"])
        end = begin + F.char_length(x["body"])
        loss = (x["role"] == TARGET) & ~x["repeated"]
        span = F.struct(begin.alias("begin"), end.alias("end"), x["repeated"].alias("repeated"), loss.alias("loss"))
        return F.struct((end + len(TURN_END)).alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    kind = "struct<at:int,spans:array<struct<begin:int,end:int,repeated:boolean,loss:boolean>>>"
    empty = F.struct(F.lit(len(BEGIN)).alias("at"), F.array().alias("spans")).cast(kind)
    return F.aggregate("turns", empty, lambda state, x: step(state, x).cast(kind), lambda state: state["spans"])


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, window, turns (role, text, repeated) and targets, the unescaped texts under the loss mask."""
    inner = F.substring("text", len(BEGIN) + 1, 1 << 30)
    pieces = formatted.select("conv_id", "window", "text", "spans", F.split(inner, TURN_END, -1).alias("pieces"))
    mark = r"^<\|([^|]*)\|>\n"
    turns = F.zip_with(
        F.slice("pieces", 1, F.size("pieces") - 1),
        "spans",
        lambda piece, span: F.struct(
            unescaped_role(F.regexp_extract(piece, mark, 1)).alias("role"),
            unescaped(F.regexp_replace(piece, mark, "")).alias("text"),
            span["repeated"].alias("repeated"),
        ),
    )
    masked = F.filter("spans", lambda span: span["loss"])
    targets = F.transform(masked, lambda x: unescaped(F.substring(F.col("text"), x["begin"] + 1, x["end"] - x["begin"])))
    return pieces.select("conv_id", "window", turns.alias("turns"), targets.alias("targets"), F.char_length("text").alias("chars"))
