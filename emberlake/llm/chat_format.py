"""Chat formatting by prefix-target expansion: each assistant turn becomes an example of its own, whose context is all
that was said before and of which only the reply is trained."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Control strings of common chat templates. Texts must not hold any of them unescaped.
START, END = "<|im_start|>", "<|im_end|>"
CONTROL_STRINGS = [START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
TRAINED_ROLE = "assistant"
_BACKSLASH = "\\"


def escape(text: Column) -> Column:
    """Doubles backslashes and breaks every control string by one behind its first character. Reversible."""
    result = F.replace(text, F.lit(_BACKSLASH), F.lit(_BACKSLASH * 2))
    for control in CONTROL_STRINGS:
        result = F.replace(result, F.lit(control), F.lit(control[0] + _BACKSLASH + control[1:]))
    return result


def escape_role(role: Column) -> Column:
    """A role ends at the first plain line break, so its own are escaped too."""
    return F.replace(escape(role), F.lit("\n"), F.lit(_BACKSLASH + "\n"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), escape_role(role), F.lit("\n"), escape(text), F.lit(END + "\n"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, replies): one row per conversation of ``turns`` (conv_id, turn, role, text).

    ``formatted`` holds all turns by turn number; ties go by role, then text, and a null number comes first. ``replies``
    lists (start, length) of each assistant text in it, in code points from 0, still escaped: the loss mask. Null roles
    and texts are empty, a null conv_id is a conversation, repeated rows are turns of their own. Other columns are
    ignored; an empty table gives an empty table.
    """
    piece = F.struct(F.col("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                     F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    gathered = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(piece)).alias("turns"))
    shaped = gathered.select("conv_id", F.transform("turns", lambda t: F.struct(
        format_turn(t["role"], t["text"]).alias("shown"),
        (F.length(escape_role(t["role"])) + len(START) + 1).alias("before"),
        F.length(escape(t["text"])).alias("length"),
        (t["role"] == TRAINED_ROLE).alias("trained"))).alias("turns"))
    walk = F.aggregate(
        "turns", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("replies")),
        lambda done, t: F.struct(
            (done["at"] + F.length(t["shown"])).alias("at"),
            F.when(t["trained"], F.concat(done["replies"], F.array(F.struct(
                (done["at"] + t["before"]).alias("start"), t["length"].alias("length"))))).otherwise(done["replies"]).alias("replies")))
    return shaped.select("conv_id", F.array_join(F.transform("turns", lambda t: t["shown"]), "").alias("formatted"),
                         walk["replies"].alias("replies"))


def expand_examples(conversations: DataFrame) -> DataFrame:
    """(conv_id, example, prompt, reply): every assistant turn after all turns before it; only ``reply`` is trained.

    Both are text as formatted. The prompt ends where the reply begins, behind the opening of its own turn.
    """
    each = conversations.select("conv_id", "formatted", F.posexplode("replies").alias("example", "span"))
    return each.select("conv_id", "example", F.expr("left(formatted, span.start)").alias("prompt"),
                       F.expr("substring(formatted, span.start + 1, span.length)").alias("reply"))


def parse_turns(formatted: Column) -> Column:
    """An array of (role, text), read back from formatted text; the inverse of formatting."""
    # possessive, so that a role of any length takes no stack
    body = r"((?:[^\\\n]++|\\(?s:.))*+)\n((?s:.*))"
    pieces = F.filter(F.split(formatted, r"\Q" + END + r"\E\n"), lambda p: p.startswith(START))
    return F.transform(pieces, lambda p: F.struct(
        unescape(F.regexp_extract(F.substring(p, len(START) + 1, 2**31 - 1), body, 1)).alias("role"),
        unescape(F.regexp_extract(F.substring(p, len(START) + 1, 2**31 - 1), body, 2)).alias("text")))


def summarize(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_examples, context_chars), all read
    back from the output: the turns by parsing ``formatted``, the trained text from the examples' replies, in order."""
    turns = conversations.withColumn("turns", parse_turns(F.col("formatted")))
    listed = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    said = turns.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(listed, 256).alias("turns_sha256"),
                        F.length("formatted").cast("long").alias("formatted_chars"))
    replies = (expand_examples(conversations).groupBy(F.col("conv_id").alias("of")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("example", unescape(F.col("reply")).alias("reply")))),
                                 lambda e: e["reply"]), "").alias("loss"),
        F.count("*").alias("n_examples"), F.sum(F.length("prompt")).alias("context_chars")))
    loss = F.coalesce("loss", F.lit(""))
    return said.join(replies, said["conv_id"].eqNullSafe(replies["of"]), "left").select(
        "conv_id", "n_turns", "turns_sha256", F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars", F.coalesce("n_examples", F.lit(0)).cast("long").alias("n_examples"),
        F.coalesce("context_chars", F.lit(0)).cast("long").alias("context_chars"))
