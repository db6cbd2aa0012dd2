"""Standard forms of columns."""

from __future__ import annotations

from pyspark.sql import Column


def whole_number(value: Column, dtype: str = "int") -> Column:
    """Integer of a number or numeric text ('1.0' included); NULL where it is neither."""
    return value.try_cast("double").try_cast(dtype)
