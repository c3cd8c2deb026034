"""Dense row keys (inventory A3).

A global ``row_number()`` funnels every row into one task and
``monotonically_increasing_id`` is unique but not dense; ``dense_key`` uses
the range-partitioned position of :mod:`rarelab.operators.ordered`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarelab.operators.ordered import dense_position


def dense_key(df: DataFrame, order_cols: list, name: str = "row_key", start: int = 1, materialize: bool = False) -> DataFrame:
    """A3: a dense ``start``-based key in ``order_cols`` order.

    The rows are written once.  Their plan runs for the count, the splitters and the rows; where it is
    costlier than a scan, ``materialize`` writes its result down first."""
    return dense_position(df, order_cols, name, materialize=materialize).withColumn(name, F.col(name) + F.lit(start))
