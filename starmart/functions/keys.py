"""Surrogate keys, effective dates and comparisons."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType


def surrogate_key(business_key: Column, effective_from: Column) -> Column:
    return F.sha2(F.concat_ws("||", business_key, effective_from.cast("string")), 256)


def unless_made(key: str, made: Column) -> Column:
    """Nothing where the key is what it is usually ``made`` of, else an array of it: what has to move so that ``made_again``
    gives the key. Shuffles and sorts would mostly move the 64 characters of a surrogate key."""
    return F.when(~F.col(key).eqNullSafe(made), F.array(key))


def made_again(other: Column, made: Column) -> Column:
    return F.when(other.isNull(), made).otherwise(F.get(other, F.lit(0)))


def text_key_in(stored: str, texts: Sequence[str]) -> Column:
    """Filter for a whole-number column whose text is one of ``texts``, on the column itself.

    A filter on the text of a column never reaches the file scan; this one is pushed as an equality or IN. Texts that no
    number is written as, such as ``007``, match nothing.
    """
    numbers = [int(t) for t in texts if re.fullmatch(r"0|-?[1-9][0-9]{0,18}", t) and -(1 << 63) <= int(t) < 1 << 63]
    if not numbers:
        return F.lit(False)
    return F.col(stored) == F.lit(numbers[0]) if len(numbers) == 1 else F.col(stored).isin(numbers)


def null_safe_eq(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def any_differs(pairs: list[tuple[Column, Column]]) -> Column:
    """True when a pair differs; a NULL on either side of a pair counts as no difference."""
    return reduce(or_, [a != b for a, b in pairs])


def effective_update_date(schema: StructType, updated: str, created: str) -> Column:
    """Update date, or the creation date of rows never updated. Text dates must read ``yyyy-MM-dd``."""
    column = F.col(updated)
    if not isinstance(schema[updated].dataType, DateType):
        column = F.to_date(column.cast("string"), "yyyy-MM-dd")
    return F.coalesce(column, F.col(created))


def updated_after(schema: StructType, updated: str, created: str, watermark: Column) -> Column:
    """Filter for ``effective_update_date > watermark``, split over the raw columns where those are dates.

    File scans take the split form as a pushed filter; a coalesce they cannot.
    """
    if isinstance(schema[updated].dataType, DateType):
        return (F.col(updated) > watermark) | (F.col(updated).isNull() & (F.col(created) > watermark))
    return effective_update_date(schema, updated, created) > watermark
