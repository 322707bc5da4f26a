"""Texts of any length as rows of bounded length, with the same terms.

A long text is cut near every multiple of the chunk's length, at the first separator
from there on, so no term is cut. A task has the text and one chunk of it at a time,
never the arrays that all its terms would be. As a place in a text is found by counting
characters from its beginning, texts are cut by levels, into few parts each time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters that separate terms.
_SEPARATORS = (" ", "\t", "\n", "\x0b", "\f", "\r")
CHUNK_BYTES = 1 << 20
# Parts that a text is cut into at a level, about; with three levels, 2 GB in parts of 1 MB.
_PARTS = 16
_LEVELS = 3
# Characters that are searched for a separator first; few terms are longer.
_NEAR = 256


def is_long(text: Column, chunk_bytes: int) -> Column:
    return F.coalesce(F.octet_length(text) > F.lit(chunk_bytes), F.lit(False))


def _before_separator(text: Column) -> Column:
    """Characters before the first separator; all, where there is none."""
    return F.least(*(F.char_length(F.substring_index(text, s, 1)) for s in _SEPARATORS))


def _cut_rows(corpus: DataFrame, size: int) -> DataFrame:
    """Rows with texts of more than ``size`` bytes cut at about every ``size`` characters; others as they are."""
    others = [c for c in corpus.columns if c != "text"]
    text, long = F.col("text"), is_long(F.col("text"), size)
    last = F.when(long, F.floor(F.octet_length(text) / F.lit(size)).cast("int")).otherwise(0)
    rows = corpus.select(*others, "text", F.explode_outer(F.sequence(F.lit(0), last)).alias("part"))
    # A column for each step, so that each is computed once; the text is only pointed to.
    sides = {"start": F.col("part") * F.lit(size), "end": (F.col("part") + F.lit(1)) * F.lit(size)}
    near = {f"near_{k}": F.when(long, F.substring(text, at + F.lit(1), F.lit(_NEAR))) for k, at in sides.items()}
    rows = rows.select(*others, "text", "part", *(c.alias(k) for k, c in near.items()))
    rows = rows.select("*", *(_before_separator(F.col(k)).alias(f"found_{k}") for k in near))
    cuts = []
    for k, at in sides.items():
        found, length = F.col(f"found_near_{k}"), F.char_length(f"near_{k}")
        rest = F.substring(text, at + F.lit(1), F.octet_length(text))
        # A first part begins where the text does.
        begins = F.lit(k == "start") & (F.col("part") == 0)
        place = F.when(begins, 0).when(found < length, found).otherwise(_before_separator(rest))
        cuts.append(F.when(long, at + place).alias(k))
    rows = rows.select(*others, "text", *cuts)
    # A part beyond the text's end, counted in characters, is empty, as one within a term is.
    part = F.substring(text, F.col("start") + F.lit(1), F.greatest(F.col("end") - F.col("start"), F.lit(0)))
    return rows.select(*others, F.when(long, part).otherwise(text).alias("text"))


def bounded_lines(corpus: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``corpus`` at line grain: the same terms in rows of about ``chunk_bytes`` characters.

    A row that has no more bytes stays as it is. Only terms that are longer than a
    chunk make longer rows.
    """
    if chunk_bytes < 1:
        raise ValueError(f"chunk_bytes must be positive, not {chunk_bytes}")
    for level in reversed(range(_LEVELS)):
        corpus = _cut_rows(corpus, chunk_bytes * _PARTS**level)
    return corpus
