"""What several operators share: text conventions, folds and row ids."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def fold(doc_id: Column, folds: int) -> Column:
    """Which of ``folds`` parts a row belongs to, by its id's text; a null id counts as empty."""
    text = F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")
    return (F.crc32(text) % folds).cast("int")


def is_held_out(doc_id: Column, folds: int) -> Column:
    return fold(doc_id, folds) == 0


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that operators read; a null text is an empty one."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))

