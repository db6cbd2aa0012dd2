"""Record hash over business columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from tidemark.operators.common import col

# Separator and digest size of the hash.
SEPARATOR = "||"
DIGEST_BITS = 256


def record_hash(columns: Sequence[str]) -> Column:
    """SHA-256 of the columns as text. NULL and '' hash alike and the separator is not escaped, so use
    it to find rows quickly, never as the only test for a change."""
    texts = [F.coalesce(col(name).cast("string"), F.lit("")) for name in columns]
    return F.sha2(F.concat_ws(SEPARATOR, *texts), DIGEST_BITS)
