"""Documentation comments and signatures as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .uri import collapse, strip


def is_doxygen(text: Column) -> Column:
    return strip(text).rlike(r"\A(?:/\*\*|///|//!|/\*!)")


def clean_doxygen(text: Column) -> Column:
    """The text of a comment without its markers and empty lines."""

    def line(x: Column, i: Column) -> Column:
        s = strip(x)
        s = F.when(i == 0, F.regexp_replace(s, r"\A(?:///|//!|/\*\*|/\*!)", "")).otherwise(F.regexp_replace(s, r"\A(?:///|//!)", ""))
        s = F.regexp_replace(strip(s), r"\*/\z", "")
        return strip(F.regexp_replace(strip(s), r"\A\*", ""))

    return F.array_join(F.filter(F.transform(F.split(text, "\n"), line), lambda x: x != ""), "\n")


def signature_source(code: Column) -> Column:
    """What stands before the first brace or semicolon, with single blanks."""
    return collapse(F.regexp_extract(strip(code), r"\A[^{;]*", 0))


def embedding_text(docstring: Column, code: Column, limit: int = 32_764) -> Column:
    """Docstring, line end and code, cut to ``limit`` characters."""
    whole = F.when(docstring.isNotNull() & (docstring != ""), F.concat(docstring, F.lit("\n"), code)).otherwise(code)
    return F.substring(whole, 1, limit)


