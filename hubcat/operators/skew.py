"""Join against a unique side that survives hot and missing keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

_SPREAD = "__spread"


def join_unique(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join on ``key``; ``right`` should hold one row per key, else rows multiply as in any join.

    Rows without a key match nothing, so they are spread by the partition they come from
    instead of meeting in one task. The second join key also makes both sides shuffle for
    this join alone, even when ``right`` is already grouped by ``key``: only then can
    adaptive execution see a hot key and split its rows over several tasks, each against
    the right rows of that key. A right side that turns out small is broadcast at run time.
    """
    spread = F.when(F.col(key).isNull(), F.spark_partition_id()).otherwise(F.hash(key))
    return (
        left.withColumn(_SPREAD, spread)
        .join(right.withColumn(_SPREAD, F.hash(key)), [key, _SPREAD], how)
        .drop(_SPREAD)
    )
