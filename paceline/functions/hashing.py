"""Digests of row groups that do not depend on row order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def hash_rows(df: DataFrame, by: Sequence[str], row_text: Column, name: str = "digest") -> DataFrame:
    """Twelve hex digits per group: SHA-256 per row, the words of the digests added up, SHA-256 again.

    Sums combine on the map side and need constant memory, where sorting the rows of a group would
    hold all of them.
    """
    hashed = df.select(*by, F.sha2(row_text, 256).alias("_h"))
    words = [F.sum(F.conv(F.substring("_h", at, 15), 16, 10).cast("decimal(20,0)")).cast("string") for at in (1, 16, 31, 46)]
    total = F.concat_ws("|", F.count(F.lit(1)).cast("string"), *words)
    return hashed.groupBy(*by).agg(F.substring(F.sha2(total, 256), 1, 12).alias(name))
