"""Top-k whose last task stays small however many tasks read the input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Tasks are folded into this many groups; the last task sees at most GROUPS * n rows.
GROUPS = 512
# Largest n: Spark cuts ranks up to here before a window's shuffle. Longer lists are numbered with ``positions``.
MAX_ROWS = 1000


def top_k(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """First ``n`` rows along ``order``, at most ``MAX_ROWS``, for scans of any width and number of tasks.

    A plain top-k ships ``n`` rows of every task to one task. Here the tasks
    first meet in groups, so that a scan of 100,000s of tasks does not.
    """
    if n > MAX_ROWS:
        raise ValueError(f"at most {MAX_ROWS} rows; use batching.first_rows for more")
    ranked = Window.partitionBy("_group").orderBy(*order)
    few = (
        df.withColumn("_group", F.spark_partition_id() % GROUPS)
        .withColumn("_thin", F.row_number().over(ranked))
        .filter(F.col("_thin") <= n)
        .drop("_group", "_thin")
    )
    return few.orderBy(*order).limit(n)
