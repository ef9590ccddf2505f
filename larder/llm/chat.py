"""Chat formatting into budgeted windows, with DataFrame functions only.

Prefix sums of turn tokens cut a conversation into turn-aligned spans: the token line falls into cells of the span
budget, and a turn that crosses a cell's end joins the span before it if it fits, else stands alone. Each window holds
the system turn, a limited stretch of the turns before its span, and the span. The loss mask covers the assistant turns
of the span; in the repeated turns they are masked. So every turn is a target in one window only.

Nothing gathers a conversation: prefix sums run in blocks of turn numbers, then over the blocks, and every other group
is bounded by the token budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.sources.staging import settle

BUDGET = 1024
HISTORY = 256
MIN_SPAN = 128
TURNS_A_BLOCK = 256
TURN_TOKENS = 4  # of the marks around a turn

START, END = "<|im_start|>", "<|im_end|>\n"
# fixed values: what opens a control string of common templates, as first character and rest
CONTROL = r"(\||/?s>|<SYS>>|</SYS>>|/?INST\])"


def escape(text: Column) -> Column:
    """Break up control strings: backslashes are doubled, then one is put after a control string's first character."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, rf"([<\[]){CONTROL}", r"$1\\$2")


def unescape(text: Column) -> Column:
    joined = F.regexp_replace(text, rf"([<\[])\\{CONTROL}", "$1$2")
    return F.replace(joined, F.lit("\\\\"), F.lit("\\"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\n"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\n"), F.lit("\n")))


def tokens_of(text: Column) -> Column:
    """Words and marks of a text, plus the marks around a turn."""
    return (F.regexp_count(text, F.lit(r"\w+|[^\w\s]")) + TURN_TOKENS).cast("long")


def _numbered(turns: DataFrame) -> DataFrame:
    """Each turn's place in its conversation, and the tokens before it; the leading system turn takes none."""
    block = F.floor(F.coalesce("turn", F.lit(-1)) / TURNS_A_BLOCK)
    rows = turns.withColumn("block", block)
    here = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    rows = rows.withColumn("place", F.row_number().over(here))
    before = rows.groupBy("conv_id", "block").agg(F.count("*").alias("turns"), F.sum("tokens").alias("sum"), F.min(F.struct("turn", "role", "text", "tokens")).alias("lead"))
    along = Window.partitionBy("conv_id").orderBy("block")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    lead = F.first("lead").over(along)
    before = before.select(
        F.col("conv_id").alias("c"),
        F.col("block").alias("b"),
        F.coalesce(F.sum("turns").over(earlier), F.lit(0)).alias("turns_before"),
        F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("sum_before"),
        F.when(lead["role"] == "system", lead).alias("system"),
    )
    same = rows["conv_id"].eqNullSafe(before["c"]) & (rows["block"] == before["b"])
    joined = rows.join(before, same).drop("c", "b")
    index = (F.col("turns_before") + F.col("place") - 1).alias("index")
    head = F.col("system").isNotNull() & (F.col("turns_before") + F.col("place") == 1)
    head_tokens = F.coalesce(F.col("system.tokens"), F.lit(0))
    until = F.col("sum_before") + F.sum("tokens").over(here.rowsBetween(Window.unboundedPreceding, 0)) - head_tokens
    return joined.select("conv_id", index, "turn", "role", "text", "tokens", "system", head.alias("is_head"), until.alias("until"))


def windows(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    budget: int = BUDGET,
    history: int = HISTORY,
    min_span: int = MIN_SPAN,
    target: str = "assistant",
) -> DataFrame:
    """One row per window: (conv_id, at, formatted, loss, n_repeated, n_turns, n_tokens).

    `at` orders a conversation's windows. `formatted` is the text, `loss` an array of (start, length) in its code
    points, `n_repeated` the number of leading turns that another window already has. Turns are ordered by number, then
    role and text; a null number comes first, a null text or role is empty, repeated rows are turns of their own and a
    null conversation id is a conversation. A window exceeds `budget` only by a turn too long for it, or a system turn
    that leaves less than `min_span`; turns are never cut. Other columns aren't read.
    """
    own = turns.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(role, F.lit("")).alias("role"),
        F.coalesce(text, F.lit("")).alias("text"),
    )
    rows = _numbered(own.withColumn("tokens", tokens_of(F.col("text"))))
    span = F.greatest(F.lit(budget - history) - F.coalesce(F.col("system.tokens"), F.lit(0)), F.lit(min_span))
    since = F.when(F.col("is_head"), F.col("until")).otherwise(F.col("until") - F.col("tokens"))
    rows = rows.withColumn("since", since).withColumn("span", span).withColumn("cell", F.floor(F.col("since") / F.col("span")))
    cell_start = F.min("since").over(Window.partitionBy("conv_id", "cell"))
    crosses = F.col("until") > (F.col("cell") + 1) * F.col("span")
    alone = crosses & (F.col("until") - cell_start > F.col("span"))
    rows = rows.withColumn("alone", alone)
    start = F.when(F.col("alone"), F.col("since")).otherwise(F.min(F.when(~F.col("alone"), F.col("since"))).over(Window.partitionBy("conv_id", "cell")))
    rows = settle(rows.withColumn("at", F.struct(start.alias("start"), F.col("alone").alias("alone"))), "chat_turns")
    member = F.struct("index", "role", "text", "tokens")
    mine = rows.select("conv_id", "at", F.lit(False).alias("repeated"), member.alias("m"))
    spans = rows.groupBy("conv_id", "at").agg(F.any_value("system").alias("system"), F.bool_or("is_head").alias("has_head"))
    system = F.struct(F.lit(0).cast("long").alias("index"), F.col("system.role").alias("role"), F.col("system.text").alias("text"), F.col("system.tokens").alias("tokens"))
    heads = spans.where(F.col("system").isNotNull() & ~F.col("has_head")).select("conv_id", "at", F.lit(True), system)
    # a turn is history of the spans that start within `history` tokens of its start; both meet in bins of that width
    bins = F.sequence(F.floor(F.col("until") / history), F.floor((F.col("since") + history) / history))
    earlier = rows.where(~F.col("is_head") & (F.col("tokens") <= history)).select(F.col("conv_id").alias("c"), "since", "until", member.alias("m"), F.explode(bins).alias("bin"))
    starts = spans.select("conv_id", "at", F.floor(F.col("at.start") / history).alias("b"))
    near = starts["conv_id"].eqNullSafe(earlier["c"]) & (starts["b"] == earlier["bin"])
    within = (F.col("until") <= F.col("at.start")) & (F.col("since") >= F.col("at.start") - history)
    repeats = starts.join(earlier, near).where(within).select("conv_id", "at", F.lit(True), "m")
    grouped = mine.union(heads).union(repeats).groupBy("conv_id", "at").agg(F.sort_array(F.collect_list(F.struct("m.index", "repeated", "m.role", "m.text", "m.tokens"))).alias("turns"))
    parts = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(START), _escape_role(t["role"]), F.lit("\n")).alias("open"),
            escape(t["text"]).alias("body"),
            (~t["repeated"] & (t["role"] == target)).alias("counts"),
        ),
    )
    shaped = grouped.withColumn("parts", parts)
    begins = F.aggregate(
        "parts",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("loss")),
        lambda state, p: F.struct(
            (state["at"] + F.length(p["open"]) + F.length(p["body"]) + len(END)).alias("at"),
            F.when(
                p["counts"],
                F.concat(state["loss"], F.array(F.struct((state["at"] + F.length(p["open"])).alias("start"), F.length(p["body"]).cast("long").alias("length")))),
            ).otherwise(state["loss"]).alias("loss"),
        ),
        lambda state: state["loss"],
    )
    return shaped.select(
        "conv_id",
        "at",
        F.concat_ws("", F.transform("parts", lambda p: F.concat(p["open"], p["body"], F.lit(END)))).alias("formatted"),
        begins.alias("loss"),
        F.size(F.filter("turns", lambda t: t["repeated"])).cast("long").alias("n_repeated"),
        F.size("turns").cast("long").alias("n_turns"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + t["tokens"]).alias("n_tokens"),
    )


def turns_of(formatted: Column) -> Column:
    """The turns of a window as structs (role, text), read back from its text."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n", -1), lambda b: b != "")

    def parse(block: Column) -> Column:
        role = F.substring_index(F.substring(block, len(START) + 1, 1 << 30), "\n", 1)
        body = F.substring(block, F.lit(len(START) + 2) + F.length(role), F.lit((1 << 31) - 1))
        return F.struct(_unescape_role(role).alias("role"), unescape(body).alias("text"))

    return F.transform(blocks, parse)


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the windows' text and loss masks alone: turn count, loss, lengths and digests.

    A conversation's digest is of one string, so its windows meet in one row here, and only here.
    """
    fresh = F.slice(turns_of(F.col("formatted")), F.col("n_repeated").cast("int") + 1, (F.col("n_turns") - F.col("n_repeated")).cast("int"))
    masked = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    parts = formatted.withColumn("fresh", fresh).select(
        "conv_id",
        F.struct(
            "at",
            F.size("fresh").cast("long").alias("n"),
            F.concat_ws("", F.transform("fresh", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))).alias("turns"),
            F.concat_ws("", masked).alias("loss"),
            F.length("formatted").cast("long").alias("chars"),
        ).alias("w"),
    )
    whole = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list("w")).alias("w"))

    def total(field: str) -> Column:
        return F.aggregate("w", F.lit(0).cast("long"), lambda a, w: a + w[field])

    def joined(field: str) -> Column:
        return F.concat_ws("", F.transform("w", lambda w: w[field]))

    return whole.select(
        "conv_id",
        total("n").alias("n_turns"),
        F.sha2(F.encode(joined("turns"), "UTF-8"), 256).alias("turns_sha256"),
        F.length(joined("loss")).cast("long").alias("loss_chars"),
        F.sha2(F.encode(joined("loss"), "UTF-8"), 256).alias("loss_sha256"),
        total("chars").alias("formatted_chars"),
    )
