"""Chat formatting as one relational expression over the collected turns of a conversation.

A conversation's rows become one sorted array of structs. Adjacent turns of one role are merged
into a block by slicing that array at the role changes, and blocks are concatenated:

    [INST role]text[TURN]text</s>

``\\``, ``[``, ``]`` and ``<`` inside roles and texts are escaped, so that no text can contain a
control string; ``read_conversations`` gives back the turns exactly. Everything is Spark
expressions, and every step is linear in the length of a conversation.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Each character and what stands for it; the first one is escaped first and restored last.
ESCAPES = (("\\", "\\0"), ("[", "\\1"), ("]", "\\2"), ("<", "\\3"))
OPEN, CLOSE_ROLE, TURN, END = "[INST ", "]", "[TURN]", "</s>"


def escape(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def format_conversations(
    rows: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    loss_roles: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` and ``segments``.

    ``segments`` are the pieces of ``formatted`` in order, each with the flag ``loss``; the pieces
    that carry the flag are the texts of ``loss_roles``, escaped, and nothing else.

    Rows are ordered by turn, nulls first; rows that share a turn by role, then text, so that the
    result does not depend on the order of the input, and repeated rows all stay. A null role or
    text counts as the empty one. Rows with a null conversation form a conversation of their own.
    Other columns are ignored; no rows give no rows.
    """
    turns = rows.select(
        F.col(conversation).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("row"),
    )
    collected = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    starts = F.filter(
        F.sequence(F.lit(0), F.size("rows") - 1),
        lambda i: (i == 0) | (F.get("rows", i)["role"] != F.get("rows", i - 1)["role"]),
    )
    merged = collected.select("conv_id", "rows", starts.alias("starts")).select(
        "conv_id",
        F.transform(
            "starts",
            lambda s, k: F.struct(
                F.get("rows", s)["role"].alias("role"),
                F.transform(
                    F.slice("rows", s + 1, F.coalesce(F.get("starts", k + 1), F.size("rows")) - s),
                    lambda row: row["text"],
                ).alias("texts"),
            ),
        ).alias("blocks"),
        F.size("rows").alias("n_rows"),
    )

    def pieces(block: Column) -> Column:
        mark = lambda value: F.array(F.struct(value.alias("text"), F.lit(False).alias("loss")))
        said = F.flatten(
            F.transform(
                block["texts"],
                lambda x, i: F.concat(
                    mark(F.when(i > 0, F.lit(TURN)).otherwise(F.lit(""))),
                    F.array(F.struct(escape(x).alias("text"), block["role"].isin(*loss_roles).alias("loss"))),
                ),
            )
        )
        head = mark(F.concat(F.lit(OPEN), escape(block["role"]), F.lit(CLOSE_ROLE)))
        return F.concat(head, said, mark(F.lit(END)))

    segments = F.filter(F.flatten(F.transform("blocks", pieces)), lambda s: (s["text"] != "") | s["loss"])
    cut = merged.select("conv_id", segments.alias("segments"))
    return cut.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def read_conversations(formatted: DataFrame) -> DataFrame:
    """``conv_id`` and ``turns`` (an array of role and text), read from the formatted text alone."""
    blocks = F.filter(F.split("formatted", END, -1), lambda b: b != "")

    def turns(block: Column) -> Column:
        said = F.substr(block, F.instr(block, CLOSE_ROLE) + 1)
        role = F.substring_index(F.substr(block, F.lit(len(OPEN) + 1)), CLOSE_ROLE, 1)
        return F.transform(
            F.split(said, r"\[TURN\]", -1),
            lambda text: F.struct(unescape(role).alias("role"), unescape(text).alias("text")),
        )

    return formatted.select("conv_id", F.flatten(F.transform(blocks, turns)).alias("turns"), "formatted", "segments")
