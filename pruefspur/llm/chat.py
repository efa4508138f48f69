"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the context, and only
its text is under the loss mask.  Turns that no reply follows go out as one last example with an
empty mask, so that the output holds every turn and can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, END = "[TURN]", "</s>"
#: Control strings of this and of common chat templates; none of them stands unescaped in a text.
CONTROL = r"([<\[])(?=/?s>|/?INST\]|/?TURN\]|/?SYS>|\|)"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    """Double the backslashes, then put one behind the first character of a control string."""
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), CONTROL, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _role(role: Column) -> Column:
    """A role ends at the first line break, so one inside it is written as an escape."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def _role_back(role: Column) -> Column:
    return unescape(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))


def format_examples(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per example: the conversation, ``example`` (0, 1, ...), ``n_context`` turns before the
    target, ``formatted``, and the mask as ``mask_start`` and ``mask_chars`` in code points.

    Rows go by turn, then role and text; a null turn comes first, and repeated rows are turns of
    their own.  A null text or role is an empty one.  A null conversation id is one conversation.
    An example without a target has an empty mask.  Other columns are not read.  The examples hold
    each prefix in full, so their size is that of a conversation times its replies: this is what
    the format asks for, and a conversation is the unit that has to fit a task.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.select(
        F.col(conv).alias("_conv"), F.col(turn).alias("_turn"), blank(role).alias("_role"), blank(text).alias("_text")
    )
    whole = rows.groupBy("_conv").agg(
        F.sort_array(F.collect_list(F.struct("_turn", "_role", "_text"))).alias("_turns")
    )
    head = lambda t: F.concat(F.lit(TURN), _role(t["_role"]), F.lit("\n"))
    parts = F.transform(
        "_turns",
        lambda t: F.struct(
            head(t).alias("head"), escape(t["_text"]).alias("body"), (t["_role"] == ASSISTANT).alias("target")
        ),
    )
    parted = whole.select("_conv", F.explode(F.array(parts)).alias("_parts"))
    n = F.size("_parts")
    ends = F.filter(
        F.transform("_parts", lambda p, i: F.when(p["target"] | (i == n - 1), i)), lambda i: i.isNotNull()
    )
    examples = parted.select("_conv", "_parts", F.posexplode(ends).alias("example", "n_context"))
    last = F.get("_parts", F.col("n_context"))
    before = F.array_join(
        F.transform(
            F.slice("_parts", F.lit(1), F.col("n_context")), lambda p: F.concat(p["head"], p["body"], F.lit(END))
        ),
        "",
    )
    made = examples.select(
        "_conv",
        F.col("example").cast("bigint").alias("example"),
        F.col("n_context").cast("bigint").alias("n_context"),
        F.concat(before, last["head"]).alias("_prompt"),
        last["body"].alias("_body"),
        last["target"].alias("_target"),
    )
    return made.select(
        F.col("_conv").alias(conv),
        "example",
        "n_context",
        F.concat("_prompt", "_body", F.lit(END)).alias("formatted"),
        F.length("_prompt").cast("bigint").alias("mask_start"),
        F.when(F.col("_target"), F.length("_body")).otherwise(0).cast("bigint").alias("mask_chars"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted example, as an array of role and text."""
    pieces = F.split(formatted, END)
    full = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def parse(piece: Column) -> Column:
        body = F.substr(piece, F.lit(len(TURN) + 1))
        cut = F.instr(body, "\n")
        return F.struct(
            _role_back(F.substr(body, F.lit(1), cut - 1)).alias("role"), unescape(F.substr(body, cut + 1)).alias("text")
        )

    return F.transform(full, parse)


def loss_text(formatted: Column, mask_start: Column, mask_chars: Column) -> Column:
    """The text under an example's mask, unescaped."""
    return unescape(F.substr(formatted, (mask_start + 1).cast("int"), mask_chars.cast("int")))
