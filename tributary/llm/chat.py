"""Chat formatting by prefix-target expansion (DataFrame functions only).

Every assistant turn becomes an example of its own: all turns before it are
context, and only that reply carries loss.  A conversation whose last turn is
not an assistant's also gives one example without a target, so that every turn
is in some example.

Template: ``<|im_start|>ROLE\\nTEXT<|im_end|>\\n`` for each turn.  Inside roles
and texts ``&`` is written ``&amp;`` and ``<|`` is written ``&lt;|`` (in roles
also a line feed as ``&nl;``), so that control strings inside texts never read
as marks and everything comes back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of the template.
START, END = "<|im_start|>", "<|im_end|>\n"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("&nl;"))


def unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("&nl;"), F.lit("\n")))


def format_examples(turns: DataFrame, target_role: str = "assistant") -> DataFrame:
    """Rows (conv_id, turn, role, text) -> one row per example:
    conv_id, example (1-based place of its last turn), formatted,
    loss_start and loss_end (code points; both null without a target).

    Null role and text count as empty; turns with the same number follow each
    other by role, then text; null turn numbers come first; repeated rows
    are turns of their own; a null conv_id is a conversation like others.
    Other columns are ignored; an empty table gives no example.
    """
    role = F.coalesce(F.col("role"), F.lit(""))
    body = escape(F.coalesce(F.col("text"), F.lit("")))
    marked = turns.select(
        "conv_id", F.col("turn"), role.alias("role"), body.alias("body")
    ).select(
        "conv_id", F.struct("turn", "role", "body",
                            F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"),
                                     F.col("body"), F.lit(END)).alias("marked")).alias("t"))
    conv = marked.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    places = F.filter(F.sequence(F.lit(1), F.size("ts")),
                      lambda i: (F.element_at("ts", i)["role"] == target_role) | (i == F.size("ts")))
    ex = conv.select("conv_id", "ts", F.explode(places).alias("example"))
    last = F.element_at("ts", F.col("example"))
    ex = ex.select(
        "conv_id", "example",
        F.array_join(F.transform(F.slice("ts", F.lit(1), F.col("example")), lambda t: t["marked"]), "").alias("formatted"),
        F.when(last["role"] == target_role, F.length(last["body"])).alias("n"))
    loss_end = F.length("formatted") - len(END)
    return ex.select("conv_id", "example", "formatted",
                     F.when(F.col("n").isNotNull(), loss_end - F.col("n")).alias("loss_start"),
                     F.when(F.col("n").isNotNull(), loss_end).alias("loss_end"))


def parse_turns(formatted: Column) -> Column:
    """The (role, text) structs that a formatted example holds."""
    chunks = F.split(formatted, r"<\|im_end\|>\n", -1)

    def turn(chunk: Column) -> Column:
        head = F.substring_index(chunk, "\n", 1)
        return F.struct(unescape_role(F.substring(head, len(START) + 1, 2**31 - 1)).alias("role"),
                        unescape(F.substring(chunk, F.length(head) + 2, F.length(chunk))).alias("text"))

    return F.transform(F.slice(chunks, F.lit(1), F.size(chunks) - 1), turn)


def loss_text(formatted: Column, start: Column, end: Column) -> Column:
    """What the loss mask covers, unescaped; null where there is no mask."""
    return unescape(F.substring(formatted, start + 1, end - start))


def conversation_digests(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from its examples: n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars."""
    text = loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_end"))
    # Null conv_id is a group too: <=> is not needed, groupBy keeps it.
    per = examples.select("conv_id", "example", "formatted", text.alias("loss")).groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("whole"),
        F.array_sort(F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("example", "loss")))).alias("targets"),
        F.sum(F.length("formatted")).cast("long").alias("formatted_chars"))
    per = per.select("conv_id", "formatted_chars", parse_turns(F.col("whole")).alias("ts"),
                     F.array_join(F.transform("targets", lambda t: t["loss"]), "").alias("loss"))
    said = F.array_join(F.transform("ts", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return per.select("conv_id", F.size("ts").cast("long").alias("n_turns"),
                      F.sha2(said, 256).alias("turns_sha256"),
                      F.length("loss").cast("long").alias("loss_chars"),
                      F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
