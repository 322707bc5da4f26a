"""Packed text forms of keys and values, used only at the edges.

Inside the library a key is two columns and a fraction is two BIGINTs. These
functions write and read the packed text that reports and exchanged files use:
``word@doc``, ``doc@word``, ``n/m`` and ``n/doc1,doc2``.

A term may hold ``@``, a document name normally does not, so ``word@doc`` is
cut at its last ``@``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The delimiters of the packed forms.
KEY_DELIMITER = "@"
FRACTION_DELIMITER = "/"
LIST_DELIMITER = ","

_LAST_AT = r"(?s)^(.*)@([^@]*)$"


def pack_key(first: Column, second: Column) -> Column:
    return F.concat_ws(KEY_DELIMITER, first.cast("string"), second.cast("string"))


def key_head(key: Column) -> Column:
    """What stands before the last ``@``."""
    return F.regexp_extract(key, _LAST_AT, 1)


def key_tail(key: Column) -> Column:
    """What stands after the last ``@``."""
    return F.regexp_extract(key, _LAST_AT, 2)


def pack_fraction(numerator: Column, denominator: Column) -> Column:
    return F.concat_ws(
        FRACTION_DELIMITER, numerator.cast("string"), denominator.cast("string")
    )


def numerator(fraction: Column) -> Column:
    """NULL, not an error, if the text is not a number."""
    return F.substring_index(fraction, FRACTION_DELIMITER, 1).try_cast("bigint")


def denominator(fraction: Column) -> Column:
    return F.substring_index(fraction, FRACTION_DELIMITER, -1).try_cast("bigint")


def pack_postings(count: Column, docs: Column) -> Column:
    """``n/doc1,doc2,...``"""
    return F.concat(
        count.cast("string"),
        F.lit(FRACTION_DELIMITER),
        F.array_join(docs.cast("array<string>"), LIST_DELIMITER),
    )


def postings_count(packed: Column) -> Column:
    return F.substring_index(packed, FRACTION_DELIMITER, 1).try_cast("bigint")


def postings_docs(packed: Column) -> Column:
    """Documents of a packed posting list; names must not hold a comma."""
    listed = F.substr(packed, F.locate(FRACTION_DELIMITER, packed) + F.lit(1))
    return F.split(listed, LIST_DELIMITER)


def fixed_point(value: Column, places: int = 10) -> Column:
    """Decimal text. Math libraries agree on 10 places but not on 16."""
    return F.format_string(f"%.{places}f", value)
