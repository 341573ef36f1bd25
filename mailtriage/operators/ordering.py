"""Row numbers over a whole table, exact splits and small previews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from mailtriage.session import staged_table

HASH_BUCKETS = 1 << 16


def numbered(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Number all rows 1..n in the given total order without a one-task window.

    Rows are range-partitioned and sorted, and staged so that partition and position stay
    fixed.  Offsets come from one count per partition.
    """
    laid = (
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_p", F.spark_partition_id())
        .withColumn("_i", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    )
    laid = staged_table(laid, "numbered")
    # one row per partition: the running sum is over as many rows as there are partitions
    counts = laid.groupBy("_p").count()
    before = W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("_p", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_o"))
    return (laid.join(F.broadcast(offsets), "_p")
            .withColumn(name, F.col("_o") + F.col("_i") + 1).drop("_p", "_i", "_o"))


def first_middle_last(df: DataFrame, key: str) -> DataFrame:
    """First, middle (n/2, zero-based) and last row by key, with their position."""
    ids = numbered(df.select(key), [F.col(key).asc()], "_n")
    n = ids.agg(F.count("*")).scalar()
    place = (F.when(F.col("_n") == 1, "first")
             .when(F.col("_n") == n, "last")
             .when(F.col("_n") == F.floor(n / 2) + 1, "middle"))
    # at most three rows survive
    chosen = ids.withColumn("place", place).where("place is not null").drop("_n")
    return df.join(F.broadcast(chosen), key)


def split_order(key: Column, seed: int = 42) -> Column:
    """Reproducible random order of rows."""
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))


def stratified_split(df: DataFrame, key: str, label: str, test_size: float = 0.2,
                     seed: int = 42, buckets: int = HASH_BUCKETS) -> DataFrame:
    """Add ``is_test``: exactly ``round(test_size * n)`` rows of every label.

    The rows with the smallest hashes are the test rows.  The hash space is cut into
    buckets and counted, so only the one bucket per label in which the quota runs out
    needs its rows ranked.  A row without a label is an error.
    """
    checked = F.when(F.col(label).isNull(), F.raise_error(F.lit(f"rows without a value in {label}"))).otherwise(F.col(label))
    df = df.withColumn(label, checked)
    digest = split_order(F.col(key), seed)
    bucket = F.floor(F.conv(F.substring("_h", 1, 8), 16, 10).cast("long") * buckets / F.lit(1 << 32))
    rows = df.withColumn("_h", digest).withColumn("_b", bucket)
    counts = rows.groupBy(label, "_b").count()  # at most labels * buckets rows
    upto = W.partitionBy(label).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    filled = counts.select(
        F.col(label), F.col("_b"), F.col("count").alias("_c"),
        F.coalesce(F.sum("count").over(upto), F.lit(0)).alias("_below"),
        F.sum("count").over(W.partitionBy(label)).alias("_n"))
    quota = filled.withColumn("_left", F.round(F.col("_n") * test_size).cast("long") - F.col("_below"))
    edge = quota.where((F.col("_left") > 0) & (F.col("_left") < F.col("_c"))).select(label, "_b", "_left")
    whole = quota.where(F.col("_left") >= F.col("_c")).groupBy(label).agg(F.max("_b").alias("_full"))
    # the last test row inside each edge bucket
    limit = (
        rows.select(label, key, "_h", "_b").join(F.broadcast(edge), [label, "_b"])
        .withColumn("_r", F.row_number().over(W.partitionBy(label).orderBy("_h", key)))
        .where(F.col("_r") <= F.col("_left"))
        .groupBy(label).agg(F.max("_b").alias("_edge"), F.max(F.struct("_h", key)).alias("_limit"))
    )
    # one row per label
    cuts = counts.select(label).distinct().join(whole, label, "left").join(limit, label, "left")
    full = F.coalesce(F.col("_b") <= F.col("_full"), F.lit(False))
    part = (F.col("_b") == F.col("_edge")) & (F.struct("_h", key) <= F.col("_limit"))
    return (rows.join(F.broadcast(cuts), label)
            .withColumn("is_test", full | F.coalesce(part, F.lit(False)))
            .drop("_h", "_b", "_full", "_edge", "_limit"))


def random_rows(df: DataFrame, key: str, n: int = 3, seed: int = 42) -> DataFrame:
    """A fixed-size reproducible sample: the n smallest hashes (a distributed top-k)."""
    return df.orderBy(split_order(F.col(key), seed), key).limit(n)


def head(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    return df.orderBy(key).limit(n)
