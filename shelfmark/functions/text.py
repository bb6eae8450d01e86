"""Text cleaning and previews."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .udfs import once

# Java's \s is ASCII only; this class holds every code point Python's \s matches. Category Z is
# looked up at once, where listing its members would test them one by one for each character.
SPACE = r"[\p{Z}\s\x1C-\x1F\x85]"
OTHER_SPACE = r"[\p{Z}\s\x1C-\x1F\x85&&[^ ]]"  # all of them but the plain space
BREAK_TAG = rf"(?i)<br{SPACE}*/?>"
OTHER_TAG = r"<[^>]+>"


@F.pandas_udf(T.StringType())
def _decode_entities(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def clean_description(df: DataFrame, raw: str, cleaned: str) -> DataFrame:
    """Add `cleaned`: break tags to a space, other tags out, entities decoded once, spaces collapsed.

    The order is part of the contract, as the content hash rests on it. Only texts holding
    an `&` travel to Python; a null or empty text becomes ''.
    """
    text = F.coalesce(F.col(raw), F.lit(""))
    untagged = F.regexp_replace(F.regexp_replace(text, BREAK_TAG, " "), OTHER_TAG, "")
    # Each rewrite is asked for only where a cheaper look says there is something to rewrite.
    staged = df.withColumn("__bare", F.when(text.contains("<"), untagged).otherwise(text))
    decode = once(_decode_entities)
    staged = staged.withColumn("__decoded", decode(F.when(F.col("__bare").contains("&"), F.col("__bare"))))
    text = F.coalesce(F.col("__decoded"), F.col("__bare"))
    loose = text.contains("  ") | text.rlike(OTHER_SPACE)
    collapsed = F.when(loose, F.regexp_replace(text, f"{SPACE}+", " ")).otherwise(text)
    return staged.withColumn(cleaned, F.trim(collapsed)).drop("__bare", "__decoded")


def synopsis_preview(description: Column, max_len: int = 160, table_safe: bool = True) -> Column:
    """One-line preview: at most `max_len` code points, then an ellipsis.

    With `table_safe` the `|` that would break a Markdown row becomes `/` and both ends are
    stripped; without it only line feeds are flattened, as a terminal listing needs.
    """
    flat = F.coalesce(description, F.lit(""))
    if table_safe:
        flat = F.regexp_replace(F.translate(flat, "|\n", "/ "), f"^{SPACE}+|{SPACE}+$", "")
    else:
        flat = F.translate(flat, "\n", " ")
    cut = F.regexp_replace(F.substring(flat, 1, max_len), f"{SPACE}+$", "")
    return F.when(F.length(flat) > max_len, F.concat(cut, F.lit("…"))).otherwise(flat)
