"""Chat formatting by prefix-target expansion.

Every assistant turn of a conversation becomes an example of its own: all turns
before it are context, and only that reply is trainable. Turns after the last
reply would be in no example, so a conversation that ends otherwise also gets
one example without a trainable part, which holds all its turns.

The template marks turns as ``<turn role="…">…</turn>`` and a line break. Inside
roles and texts ``&``, ``<``, ``>`` and ``"`` are written as entities, so a text
that holds control strings of this or any template comes back as it was, and
every ``<`` of a formatted example is a mark of the template.

A conversation is gathered in one row, because its examples are prefixes of each
other; conversations are spread over all tasks. Examples are written out row by
row, never held together.

Defined results: a NULL text or role is empty; turns are ordered by turn number
(NULL first), then role and text; repeated rows are turns of their own; rows with
a NULL conv_id are one conversation; an empty table gives no examples; columns
beyond conv_id, turn, role and text are not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Written for the reserved characters; the first has to be escaped first and read back last.
ENTITIES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"))
TURN = r'<turn role="([^"]*)">([^<]*)</turn>\n'
TRAINABLE_ROLE = "assistant"


def escape(text: Column) -> Column:
    for plain, entity in ENTITIES:
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def unescape(text: Column) -> Column:
    for plain, entity in reversed(ENTITIES):
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return text


def format_conversations(turns: DataFrame) -> DataFrame:
    """Examples: conv_id, example (from 0), n_turns, formatted, and the loss mask.

    The loss mask covers ``loss_length`` characters of ``formatted`` from
    ``loss_start`` (from 0): the escaped reply and nothing else. ``complete`` marks
    the one example of a conversation that holds all its turns.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turn = F.struct(F.col("turn"), role.alias("role"), text.alias("text"))
    pieces = F.transform(
        F.col("turns"),
        lambda t: F.struct(
            F.concat(F.lit('<turn role="'), escape(t.role), F.lit('">')).alias("head"),
            escape(t.text).alias("body"),
            (t.role == TRAINABLE_ROLE).alias("trainable"),
        ),
    )
    close = F.lit("</turn>\n")
    gathered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    gathered = gathered.select("conv_id", pieces.alias("pieces")).select(
        "conv_id", "pieces", F.transform("pieces", lambda p: F.concat(p.head, p.body, close)).alias("lines")
    )
    exploded = gathered.select("conv_id", "lines", F.posexplode("pieces").alias("at", "piece"))
    exploded = exploded.withColumn("last", F.col("at") + 1 == F.size("lines")).filter("piece.trainable OR last")
    context = F.array_join(F.slice("lines", 1, F.col("at")), "")
    target = F.element_at("lines", F.col("at") + 1)
    mask = F.when(F.col("piece.trainable"), F.length("piece.body"))
    return exploded.select(
        "conv_id",
        F.col("at").alias("example"),
        (F.col("at") + 1).alias("n_turns"),
        F.concat(context, target).alias("formatted"),
        F.when(F.col("piece.trainable"), F.length(context) + F.length("piece.head")).alias("loss_start"),
        F.coalesce(mask, F.lit(0)).alias("loss_length"),
        F.col("last").alias("complete"),
    )


def loss_text(examples: DataFrame) -> Column:
    """What the mask covers, as it was before formatting."""
    masked = F.substring(examples["formatted"], examples["loss_start"] + 1, examples["loss_length"])
    return F.coalesce(unescape(masked), F.lit(""))


def turns_of(formatted: Column) -> Column:
    """The (role, text) pairs of a formatted example."""
    roles = F.regexp_extract_all(formatted, F.lit(TURN), F.lit(1))
    texts = F.regexp_extract_all(formatted, F.lit(TURN), F.lit(2))
    return F.transform(F.arrays_zip(roles.alias("role"), texts.alias("text")), lambda t: F.struct(unescape(t.role).alias("role"), unescape(t.text).alias("text")))


def summary(examples: DataFrame) -> DataFrame:
    """One row for each conversation, read back from its examples.

    n_turns and turns_sha256 cover all turns (role, line break, text, line break);
    loss_chars and loss_sha256 all trainable text in order; formatted_chars all
    characters of its examples.
    """
    listed = F.transform(turns_of(F.col("formatted")), lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    read = examples.select(
        "conv_id",
        "example",
        F.length("formatted").cast("long").alias("chars"),
        loss_text(examples).alias("loss"),
        F.when(F.col("complete"), listed).alias("listed"),
    )
    read = read.select("*", F.size("listed").cast("long").alias("n"), F.sha2(F.array_join("listed", ""), 256).alias("sha"))
    gathered = read.groupBy("conv_id").agg(
        F.max(F.when(F.col("listed").isNotNull(), F.col("n"))).alias("n_turns"),
        F.max("sha").alias("turns_sha256"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "loss"))), lambda e: e.loss), "").alias("loss"),
        F.sum("chars").alias("formatted_chars"),
    )
    return gathered.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
