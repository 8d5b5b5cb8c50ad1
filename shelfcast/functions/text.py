"""Text columns: normalised words and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfcast.sources.schemas import TRUE_WORDS


def truth_flag(c: str | Column) -> Column:
    """1 for any spelling of true, 0 for everything else, null included."""
    text = F.lower((F.col(c) if isinstance(c, str) else c).cast("string"))
    return F.when(text.isin(TRUE_WORDS), 1).otherwise(0)


def family_key(c: str | Column) -> Column:
    """Key form of a family name: lower case, no slash, no space."""
    return F.lower(F.regexp_replace(c, "[/ ]", ""))
