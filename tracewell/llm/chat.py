"""Chat formatting: a role automaton checks the order of turns, a template gives text segments with loss flags.

DataFrame functions only. The unit of work is the turn: state and order come from windows that sort a conversation's
turns, texts included, in one task. It may spill, but no conversation is gathered into one row to be formatted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: ``open`` and ``close`` surround a turn, ``loss`` names the roles to be learned, ``moves`` the roles that may
#: follow each state (a state is the last role, "" at the start), ``final`` the states a conversation may end in.
TEMPLATE = {
    "open": "<|im_start|>", "after_role": "\n", "close": "<|im_end|>\n", "loss": ["assistant"],
    "moves": {"": ["system", "user"], "system": ["user"], "user": ["assistant"], "assistant": ["user"]},
    "final": ["assistant"],
}


def escape(text: Column) -> Column:
    r"""Control strings made harmless: ``<|`` becomes ``<\|``, ``<\|`` becomes ``<\\|``, and so on."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%")))


def format_turns(turns: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """One row per turn: conv_id, position, role, state, segments (array of text and loss).

    ``turns`` needs conv_id, turn, role and text; other columns are ignored. Null texts and roles count as empty.
    Turns are ordered by turn, equal ones by role and text; a null turn comes first; null conv_ids are one
    conversation. ``state`` is the automaton's after the turn: the role, or ``error`` from the first turn on that the
    template's moves do not allow. Nothing is dropped: callers decide what to do with conversations in error.
    """
    base = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    allowed = [f"{a}>{b}" for a, many in template["moves"].items() for b in many]
    move = F.concat(F.coalesce(F.lag("role").over(order), F.lit("")), F.lit(">"), F.col("role"))
    stepped = base.withColumn("position", F.row_number().over(order).cast("long")).withColumn("legal", move.isin(allowed))
    so_far = F.min("legal").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    role = F.col("role")
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    segments = F.array(
        segment(F.concat(F.lit(template["open"]), _escape_role(role), F.lit(template["after_role"])), F.lit(False)),
        segment(escape(F.col("text")), role.isin(template["loss"])),
        segment(F.lit(template["close"]), F.lit(False)))
    return stepped.withColumn("in_order", so_far).select(
        "conv_id", "position", "role", F.when(F.col("in_order"), role).otherwise(F.lit("error")).alias("state"), segments.alias("segments"))


def conversation_states(formatted: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """(conv_id, turns, valid): valid if every move was allowed and the last state is final."""
    last = F.max(F.struct("position", "state"))["state"]
    return formatted.groupBy("conv_id").agg(F.count("*").alias("turns"), last.isin(template["final"]).alias("valid"))


def parse_turns(formatted: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """Turns recovered from formatted text alone: conv_id, position, role, text, learned (text under the loss mask), chars."""
    flat = formatted.select("conv_id", "position", "segments", F.array_join(F.col("segments.text"), "").alias("chars"))
    inner = F.substr(F.col("chars"), F.lit(len(template["open"]) + 1),
                     F.char_length("chars") - F.lit(len(template["open"]) + len(template["close"])))
    cut = F.instr(F.col("inner"), template["after_role"])
    learned = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: s["text"]), "")
    return flat.withColumn("inner", inner).select(
        "conv_id", "position", _unescape_role(F.substr(F.col("inner"), F.lit(1), cut - 1)).alias("role"),
        unescape(F.substr(F.col("inner"), cut + len(template["after_role"]))).alias("text"),
        unescape(learned).alias("learned"), F.char_length("chars").cast("long").alias("chars"))


def conversation_digests(parsed: DataFrame) -> DataFrame:
    """Per conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    A digest runs over the whole conversation in order, so its turns meet in one row here, and only here.
    """
    gathered = parsed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("position", "role", "text", "learned"))).alias("turns"), F.sum("chars").alias("formatted_chars"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(F.col("turns.learned"), "")
    return gathered.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                           F.char_length(learned).cast("long").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"), "formatted_chars")
