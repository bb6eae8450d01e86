"""Chat formatting: conversations to one training text each, with a loss mask, and back.

The template is `<|im_start|>ROLE\\nTEXT<|im_end|>\\n`. Neighbouring turns of one role share a block and
are parted by `<|im_sep|>`, so the turns can be read back. Inside roles and texts a backslash is put
after the `<` of every `<`, backslashes, `|`; a control string therefore never occurs in a text, and taking one
backslash out restores it. A line break in a role is written `<|nl|>`.

Spark expressions only. Lambdas read nothing but their own element: what they need of the neighbours is
zipped in, so that no array is computed again for each element.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

START, SEP, END, NEWLINE = "<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|nl|>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def running_totals(lengths: Column, width: int = 256) -> Column:
    """Sum of the elements before each one. In chunks, since appending to an array copies it."""
    def before(chunk: Column, base: Column) -> Column:
        start = F.struct(base.alias("total"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(chunk, start, lambda acc, x: F.struct(
            (acc["total"] + x).alias("total"), F.concat(acc["out"], F.array(acc["total"])).alias("out")),
            lambda acc: acc["out"])

    zero = F.lit(0).cast("bigint")
    firsts = F.sequence(F.lit(1), F.greatest(F.size(lengths), F.lit(1)), F.lit(width))
    chunks = F.transform(firsts, lambda first: F.slice(lengths, first, width))
    sums = F.transform(chunks, lambda chunk: F.aggregate(chunk, zero, lambda acc, x: acc + x))
    pairs = F.arrays_zip(chunks.alias("chunk"), before(sums, zero).alias("base"))
    return F.flatten(F.transform(pairs, lambda pair: before(pair["chunk"], pair["base"])))


def format_chats(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, spans: array of (start, stop, loss), the place of each turn's text in `formatted`.

    Places are code points, stop exclusive; spans with `loss` (the assistant's) are the loss mask. Turns are
    ordered by turn (null first), ties by role and text; repeated rows stay. A null role or text is
    empty, rows without conv_id form one conversation. An empty table gives an empty one; other columns are ignored.
    A conversation becomes one text and must therefore fit in a row.
    """
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    nobody = F.array(F.lit(None).cast("string"))
    roles = F.transform("turns", lambda t: t["role"])
    neighbours = grouped.select("conv_id", F.arrays_zip(
        F.col("turns").alias("turn"),
        F.concat(nobody, F.slice(roles, F.lit(1), F.size("turns") - 1)).alias("before"),
        F.concat(F.slice(roles, F.lit(2), F.size("turns")), nobody).alias("after")).alias("turns"))

    def part(t: Column) -> Column:
        role = t["turn"]["role"]
        header = F.concat(F.lit(START), F.replace(escape(role), F.lit("\n"), F.lit(NEWLINE)), F.lit("\n"))
        return F.struct(
            F.when(role.eqNullSafe(t["before"]), F.lit(SEP)).otherwise(header).alias("head"),
            escape(t["turn"]["text"]).alias("body"),
            F.when(role.eqNullSafe(t["after"]), F.lit("")).otherwise(F.lit(END + "\n")).alias("tail"),
            (role == LOSS_ROLE).alias("loss"))

    parts = neighbours.select("conv_id", F.transform("turns", part).alias("parts"))
    whole = F.transform("parts", lambda p: F.concat(p["head"], p["body"], p["tail"]))
    starts = running_totals(F.transform(whole, lambda p: F.length(p).cast("bigint")))
    placed = parts.select("conv_id", F.array_join(whole, "").alias("formatted"), F.arrays_zip(
        F.col("parts").alias("part"), starts.alias("start")).alias("placed"))

    def span(p: Column) -> Column:
        start = p["start"] + F.length(p["part"]["head"])
        return F.struct(start.alias("start"), (start + F.length(p["part"]["body"])).alias("stop"), p["part"]["loss"].alias("loss"))

    return placed.select("conv_id", "formatted", F.transform("placed", span).alias("spans"))


def read_chats(formatted: DataFrame) -> DataFrame:
    """conv_id, formatted, turns: array of (role, text), and loss_text: all text under the mask, both unescaped."""
    def turns_of(block: Column) -> Column:
        inner = F.substring(block, F.lit(len(START) + 1), F.length(block) - len(START + END + "\n"))
        header = F.substring_index(inner, "\n", 1)
        role = unescape(F.replace(header, F.lit(NEWLINE), F.lit("\n")))
        texts = F.split(F.substring(inner, F.length(header) + 2, F.length(inner)), r"<\|im_sep\|>")
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    blocks = F.split("formatted", r"(?=<\|im_start\|>)")
    pieces = F.split("formatted", r"(?=<\|im_(?:start|sep)\|>)")
    starts = running_totals(F.transform(pieces, lambda p: F.length(p).cast("bigint")))
    under = F.transform(
        F.arrays_zip(pieces.alias("piece"), starts.alias("at"), F.col("spans").alias("span")),
        lambda z: F.when(z["span"]["loss"], unescape(F.substring(
            z["piece"], (z["span"]["start"] - z["at"] + 1).cast("int"), (z["span"]["stop"] - z["span"]["start"]).cast("int"))))
        .otherwise(F.lit("")))
    return formatted.select("conv_id", "formatted", F.flatten(F.transform(blocks, turns_of)).alias("turns"),
                            F.array_join(under, "").alias("loss_text"))
