"""Chat formatting in budgeted windows, in DataFrame functions only.

Turns of a conversation get token counts and prefix sums. A prefix sum divided by the span size gives a turn's span; a
turn that crosses a span's end is a span of its own, so spans are turn-aligned and hold at most the span size unless one
turn alone has more. A window holds the conversation's first system turn, the turns just before the span up to
`history` tokens, and the span's turns. Loss is on assistant texts of the span only; repeated ones are masked.

The span size is what the budget leaves beside the history and the system turn. A system turn that leaves less than
`LEAST_SPAN` of the budget is still shown whole: the history goes first, then windows exceed the budget by what the
system turn has too much, so that spans keep `LEAST_SPAN` of it. Otherwise a window is over the budget only where one
turn alone is longer than a span. Letters of scripts written without spaces are a token each.

Template: `<|INDEX ROLE|>` text `<|end|>`, one turn after the other. In roles and texts `~`, `<` and `[` are written
`~0`, `~1` and `~2`, and `|` in roles `~3`, so no control string of this or the usual bracket templates can occur inside
a text, nor the end of a turn's head inside a role.

Prefix sums run in two levels, over blocks of turn numbers and inside them, so a conversation with very many turns is no
single task.

Defined cases: null text or role is empty; rows of one conversation with the same turn number follow in order of role
and text; repeated rows stay; a null `conv_id` is a conversation of its own; a null turn number comes first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET = 1024
HISTORY = 128
BLOCK = 256
#: Least share of the budget that a span keeps beside a long system turn.
LEAST_SPAN = 0.25
_UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
TOKEN = rf"[{_UNSPACED}]|[\p{{L}}&&[^{_UNSPACED}]]+|\p{{N}}|[^\x20\x09-\x0D\p{{L}}\p{{N}}{_UNSPACED}]+"
#: Tokens counted for a turn's marks.
MARKS = 4


def escaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("~"), F.lit("~0")), F.lit("<"), F.lit("~1")), F.lit("["), F.lit("~2"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("|"), F.lit("~3"))


def unescaped(text: Column) -> Column:
    for written, meant in (("~3", "|"), ("~2", "["), ("~1", "<"), ("~0", "~")):
        text = F.replace(text, F.lit(written), F.lit(meant))
    return text


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """conv_id, index (from 0), role, text, tokens, before (tokens of the turns before)."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.withColumn("tokens", F.regexp_count("text", F.lit(TOKEN)).cast("long") + MARKS)
    rows = rows.withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62))))
    totals = rows.groupBy("conv_id", "block").agg(F.count("*").alias("n"), F.sum("tokens").alias("sum"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        F.col("conv_id").alias("b_conv"), F.col("block").alias("b_block"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("rows_before"), F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("tokens_before"),
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.join(bases, rows["conv_id"].eqNullSafe(bases["b_conv"]) & (rows["block"] == bases["b_block"]))
    return joined.select(
        "conv_id",
        (F.col("rows_before") + F.count("*").over(inside)).alias("index"),
        "role", "text", "tokens",
        (F.col("tokens_before") + F.coalesce(F.sum("tokens").over(inside), F.lit(0))).alias("before"),
    )


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """conv_id, window, text, tokens, loss: array of (start, length) in code points of `text`, in order."""
    turns = turns_in_order(conversations)
    # The first system turn of each conversation, by an aggregate that is partial before it moves.
    system = turns.where("role = 'system'").groupBy(F.col("conv_id").alias("y_conv")).agg(
        F.min(F.struct("index", "role", "text", "tokens")).alias("system")
    )
    turns = turns.join(system, F.col("conv_id").eqNullSafe(F.col("y_conv")), "left").drop("y_conv")
    beside = F.lit(budget) - F.coalesce(F.col("system.tokens"), F.lit(0))
    least = max(1, round(budget * LEAST_SPAN))
    turns = turns.withColumn("past", F.least(F.lit(history), F.greatest(beside - least, F.lit(0))))
    turns = turns.withColumn("size", F.greatest(beside - F.col("past"), F.lit(least)))
    first = F.floor(F.col("before") / F.col("size"))
    crossing = first != F.floor((F.col("before") + F.col("tokens") - 1) / F.col("size"))
    turns = turns.withColumn("span", 2 * first + crossing.cast("long"))
    spans = turns.groupBy("conv_id", "span").agg(F.min("before").alias("from"), F.min("index").alias("first_index")).select(
        F.col("conv_id").alias("s_conv"), F.col("span").alias("s_span"), "from", "first_index"
    )
    same_conv = F.col("conv_id").eqNullSafe(F.col("s_conv"))
    own = turns.join(spans, same_conv & (F.col("span") == F.col("s_span"))).withColumn("fresh", F.lit(True))
    # Spans begin at least every second size, so `past` tokens before a span lie in few of the numbers before it.
    steps = 2 * F.ceil(F.col("past") / F.col("size")) + 2
    later = turns.where("past > 0").withColumn("later", F.explode(F.sequence(F.col("span") + 1, F.col("span") + steps)))
    past = (
        later.join(spans, same_conv & (F.col("later") == F.col("s_span")))
        .where((F.col("from") - F.col("before") <= F.col("past")) & (F.col("index") < F.col("first_index")))
        .drop("later")
        .withColumn("fresh", F.lit(False))
    )
    is_system = F.col("system.index") == F.col("index")
    rows = own.unionByName(past).where(F.col("fresh") | ~F.coalesce(is_system, F.lit(False)))
    turn = F.struct("index", "role", "text", "tokens", "fresh")
    grouped = rows.groupBy("conv_id", F.col("s_span").alias("window")).agg(
        F.sort_array(F.collect_list(turn)).alias("own"), F.first("system").alias("system"), F.min(F.when(F.col("fresh"), F.col("index"))).alias("first_index")
    )
    repeated = F.when(
        F.col("system").isNotNull() & ~F.exists("own", lambda t: t["index"] == F.col("system.index")),
        F.array(F.struct("system.index", "system.role", "system.text", "system.tokens", F.lit(False).alias("fresh"))),
    ).otherwise(F.array().cast(grouped.schema["own"].dataType))
    listed = grouped.select("conv_id", "window", F.concat(repeated, F.col("own")).alias("turns"))

    def written(t: Column) -> Column:
        head = F.concat(F.lit("<|"), t["index"].cast("string"), F.lit(" "), escaped_role(t["role"]), F.lit("|>"))
        body = escaped(t["text"])
        return F.struct(
            F.concat(head, body, F.lit("<|end|>")).alias("text"),
            F.length(head).alias("head"),
            F.length(body).alias("body"),
            (t["fresh"] & (t["role"] == "assistant")).alias("target"),
        )

    made = listed.select("conv_id", "window", F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + t["tokens"]).alias("tokens"), F.transform("turns", written).alias("parts"))
    places = F.aggregate(
        "parts",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("loss")),
        lambda state, p: F.struct(
            (state["at"] + F.length(p["text"])).alias("at"),
            F.when(p["target"], F.concat(state["loss"], F.array(F.struct((state["at"] + p["head"]).alias("start"), p["body"].alias("length")))))
            .otherwise(state["loss"]).alias("loss"),
        ),
        lambda state: state["loss"],
    )
    return made.select("conv_id", "window", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"), "tokens", places.alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, from the windows alone."""
    chunks = F.split("text", r"<\|end\|>")
    masked = F.transform("loss", lambda s: unescaped(F.substring(F.col("text"), s["start"] + 1, s["length"])))
    read = formatted.select(
        "conv_id", "window", F.length("text").cast("long").alias("chars"),
        F.filter(chunks, lambda c: c != "").alias("chunks"), F.array_join(masked, "").alias("masked"),
    )
    turns = read.select("conv_id", F.explode_outer("chunks").alias("chunk"))
    head = r"^<\|(\d+) ([^|]*)\|>"
    turns = turns.select(
        "conv_id",
        F.regexp_extract("chunk", head, 1).cast("long").alias("index"),
        unescaped(F.regexp_extract("chunk", head, 2)).alias("role"),
        unescaped(F.regexp_replace("chunk", head, "")).alias("text"),
    )
    # A turn that several windows repeat counts once.
    once = turns.groupBy("conv_id", "index").agg(F.first("role").alias("role"), F.first("text").alias("text"))
    line = F.concat("role", F.lit("\n"), "text", F.lit("\n"))
    said = once.groupBy("conv_id").agg(F.count("*").alias("n_turns"), F.sort_array(F.collect_list(F.struct("index", line.alias("line")))).alias("lines"))
    said = said.select("conv_id", "n_turns", F.sha2(F.array_join(F.transform("lines", lambda x: x["line"]), ""), 256).alias("turns_sha256"))
    spoken = read.groupBy(F.col("conv_id").alias("l_conv")).agg(
        F.sum("chars").alias("formatted_chars"), F.sort_array(F.collect_list(F.struct("window", "masked"))).alias("parts")
    )
    loss = F.array_join(F.transform("parts", lambda x: x["masked"]), "")
    spoken = spoken.select("l_conv", "formatted_chars", F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"))
    joined = said.join(spoken, said["conv_id"].eqNullSafe(spoken["l_conv"]))
    return joined.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
