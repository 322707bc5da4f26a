"""Text expressions: what a term is, and what a document is called."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that separate terms. Spelled out, because the
# meaning of \s differs between regex engines (some leave out \x0B).
SEPARATORS = r" \t\n\x0B\f\r"
TERM_PATTERN = f"[^{SEPARATORS}]+"
TERM_CHARACTER = f"[^{SEPARATORS}]"


def terms_of(text: Column | str) -> Column:
    """All terms of a text in order: maximal runs of non-separators, case kept."""
    return F.regexp_extract_all(text, F.lit(TERM_PATTERN), F.lit(0))


def has_terms(text: Column | str) -> Column:
    """True if the text holds at least one term; stops at its first character."""
    return F.rlike(F.col(text) if isinstance(text, str) else text, F.lit(TERM_CHARACTER))


def doc_name(path: Column | str) -> Column:
    """Last component of a path or URL."""
    return F.substring_index(path, "/", -1)
