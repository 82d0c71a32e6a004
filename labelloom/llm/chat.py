"""Chat formatting in budgeted windows.

A conversation is laid out as turn-aligned windows of bounded token count. Prefix sums of the turns' tokens choose the
windows without walking through the conversation: the token line is cut every ``stride`` tokens, the turns that lie
between two cuts form a window, and a turn that a cut goes through is a window of its own. So a window's new turns take
at most ``stride`` tokens, or are one turn that is longer by itself. Every window starts with the system turn of its
conversation, repeats up to ``history_turns`` turns before its first one if they take at most ``history_tokens``, and
carries loss only on assistant turns that are new in it.

Conversations are handled in blocks of ``block_turns`` turns, so one with a third of all rows is spread over tasks; a
window never crosses a block, and the first one of a block repeats no history.

Defined cases: a null text or role is empty; rows that share a turn number are ordered by role and text, repeated rows
are turns of their own; a null conversation id is a conversation; an empty table gives no windows; other columns are
ignored. The first turn with role ``system`` is the one retained.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloom.llm.common import let

START, END = "<|im_start|>", "<|im_end|>"
TOKEN = r"\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
TURN_TOKENS = 4
STRIDE, HISTORY_TOKENS, HISTORY_TURNS, BLOCK_TURNS = 512, 128, 2, 256


def escape(text: Column) -> Column:
    """Double every backslash, then break ``<|`` by one, so that no marker can occur inside."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), escape(role), F.lit("\n"), escape(text), F.lit(END + "\n"))


def turns_in_blocks(conversations: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """Turns with their block, their place in it and the tokens before them in it."""
    turns = conversations.select(
        "conv_id",
        F.floor(F.coalesce("turn", F.lit(-1)) / block_turns).alias("block"),
        F.coalesce("turn", F.lit(-1)).cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("tokens", F.regexp_count("text", F.lit(TOKEN)) + TURN_TOKENS)
    line = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    return turns.withColumn("pos", F.row_number().over(line)).withColumn(
        "start", F.sum("tokens").over(line.rowsBetween(Window.unboundedPreceding, 0)) - F.col("tokens")
    )


def format_windows(
    conversations: DataFrame,
    stride: int = STRIDE,
    history_tokens: int = HISTORY_TOKENS,
    history_turns: int = HISTORY_TURNS,
    block_turns: int = BLOCK_TURNS,
) -> DataFrame:
    """``(conv_id, block, window, formatted, segments)``.

    ``segments`` has, per turn in the window, the offsets (code points) of its role and text in ``formatted``, whether
    it is repeated from an earlier place and whether it is under the loss.
    """
    placed = turns_in_blocks(conversations, block_turns)
    line = Window.partitionBy("conv_id", "block").orderBy("pos")
    cut = F.floor(F.col("start") / stride)
    through = F.floor((F.col("start") + F.col("tokens") - 1) / stride) > cut
    placed = placed.withColumn("window", (2 * cut + through.cast("long")).cast("long"))
    placed = placed.withColumn("opens", F.coalesce(F.lag("window").over(line) != F.col("window"), F.lit(True)))
    ahead = F.struct("window", "opens", "start")
    placed = placed.withColumns({f"ahead{d}": F.lead(ahead, d).over(line) for d in range(1, history_turns + 1)})
    own = F.struct(F.col("window").alias("window"), F.lit(False).alias("repeated"))
    later = [
        F.when(
            (F.col("role") != "system")
            & F.col(f"ahead{d}.opens")
            & (F.col(f"ahead{d}.start") - F.col("start") <= history_tokens),
            F.struct(F.col(f"ahead{d}.window").alias("window"), F.lit(True).alias("repeated")),
        )
        for d in range(1, history_turns + 1)
    ]
    members = placed.withColumn("in", F.explode(F.filter(F.array(own, *later), lambda x: x.isNotNull()))).select(
        "conv_id",
        "block",
        "in.window",
        F.struct("pos", "in.repeated", "role", rendered(F.col("role"), F.col("text")).alias("shown")).alias("part"),
    )
    system = (
        conversations.where("role = 'system'")
        .groupBy("conv_id")
        .agg(F.min(F.struct(F.coalesce("turn", F.lit(-1)).alias("turn"), F.coalesce("text", F.lit("")).alias("text"))).alias("s"))
        .select(
            F.col("conv_id").alias("system_of"),
            F.col("s.text").alias("system_text"),
            F.floor(F.col("s.turn") / block_turns).alias("system_block"),
        )
    )
    windows = members.groupBy("conv_id", "block", "window").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    windows = windows.join(system, F.col("conv_id").eqNullSafe(F.col("system_of")), "left")
    holds_it = (F.col("block") == F.col("system_block")) & F.exists(
        "parts", lambda p: (p["role"] == "system") & ~p["repeated"]
    )
    kept = F.struct(
        F.lit(0).alias("pos"),
        F.lit(True).alias("repeated"),
        F.lit("system").alias("role"),
        rendered(F.lit("system"), F.col("system_text")).alias("shown"),
    )
    windows = windows.withColumn(
        "parts", F.when(F.col("system_text").isNull() | holds_it, F.col("parts")).otherwise(F.concat(F.array(kept), "parts"))
    )
    sizes = F.transform("parts", lambda p: F.char_length(p["shown"]))
    begun = let(
        sizes, lambda all: F.transform(all, lambda _, i: F.aggregate(F.slice(all, F.lit(1), i), F.lit(0), lambda a, n: a + n))
    )
    segment = F.transform(
        F.arrays_zip("parts", "begun"),
        lambda z: F.struct(
            (z["begun"] + len(START)).alias("role_start"),
            F.char_length(escape(z["parts"]["role"])).alias("role_length"),
            F.char_length(z["parts"]["shown"]).alias("length"),
            z["parts"]["repeated"].alias("repeated"),
            ((z["parts"]["role"] == "assistant") & ~z["parts"]["repeated"]).alias("loss"),
        ),
    )
    return (
        windows.withColumn("begun", begun)
        .select(
            "conv_id",
            "block",
            "window",
            F.array_join(F.transform("parts", lambda p: p["shown"]), "").alias("formatted"),
            segment.alias("segments"),
        )
    )


def read_back(windows: DataFrame) -> DataFrame:
    """Digests per conversation, from the formatted text and its segments alone."""
    whole = F.col("formatted")

    def role(s):
        return unescape(F.substring(whole, s["role_start"] + 1, s["role_length"]))

    def text(s):
        begin = s["role_start"] + s["role_length"] + 1
        size = s["length"] - len(START) - s["role_length"] - 1 - len(END) - 1
        return unescape(F.substring(whole, begin + 1, size))

    new = F.filter("segments", lambda s: ~s["repeated"])
    loss = F.filter("segments", lambda s: s["loss"])
    parts = windows.select(
        "conv_id",
        "block",
        F.struct(
            F.col("window").alias("window"),
            F.array_join(F.transform(new, lambda s: F.concat(role(s), F.lit("\n"), text(s), F.lit("\n"))), "").alias("turns"),
            F.array_join(F.transform(loss, text), "").alias("loss"),
        ).alias("part"),
        F.size(new).alias("n"),
        F.char_length("formatted").alias("chars"),
    )

    def joined(order: str, name: str) -> Column:
        return F.array_join(F.transform(F.sort_array(F.collect_list("part")), lambda p: p[name]), "")

    blocks = parts.groupBy("conv_id", "block").agg(
        joined("window", "turns").alias("turns"),
        joined("window", "loss").alias("loss"),
        F.sum("n").alias("n"),
        F.sum("chars").alias("chars"),
        F.count("*").alias("windows"),
    )
    return (
        blocks.select("conv_id", F.struct("block", "turns", "loss").alias("part"), "n", "chars", "windows")
        .groupBy("conv_id")
        .agg(
            joined("block", "turns").alias("turns"),
            joined("block", "loss").alias("loss"),
            F.sum("n").alias("n_turns"),
            F.sum("chars").alias("formatted_chars"),
            F.sum("windows").alias("n_windows"),
        )
        .select(
            "conv_id",
            "n_turns",
            F.sha2("turns", 256).alias("turns_sha256"),
            F.char_length("loss").cast("long").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"),
            "formatted_chars",
            "n_windows",
        )
    )
