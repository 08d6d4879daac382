"""Tables, folds, stored intermediates, running totals and components for the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from briefloom.scaling import materialise

# Word of the contracts: a run of anything but space and the controls 9-13.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage: a reliable checkpoint in the cluster's shared folder."""
    return materialise(df)


def fold_of(ident: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(ident).cast("string"), F.lit("")).cast("binary")) % folds


def running_totals(df: DataFrame, order: list[str], totals: dict[str, str], parts: int | None = None) -> DataFrame:
    """Adds, for each (new column, value column) of ``totals``, the sum of the value over all rows
    up to this one in global ``order``.

    Rows are range-sorted, every range is summed on its own, and the sums of the ranges before
    (one row for each partition) are added. No single task sees more than one range.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = stored(df.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()))
    sums = placed.groupBy("_range").agg(*[F.sum(v).alias(f"_sum_{n}") for n, v in totals.items()])
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        "_range", *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_before_{n}") for n in totals]
    )
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.join(F.broadcast(sums), "_range")  # one row a partition
        .withColumns({n: F.col(f"_before_{n}") + F.sum(v).over(inside) for n, v in totals.items()})
        .drop("_range", *[f"_before_{n}" for n in totals])
    )


def running_total(df: DataFrame, order: list[str], value: str, name: str, parts: int | None = None) -> DataFrame:
    return running_totals(df, order, {name: value}, parts)


def _stars(edges: DataFrame) -> bool:
    """Whether the edges u > v are stars already: no node is on both sides, or has two larger ends."""
    ends = edges.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("u"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    tied = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return tied.filter("up > 1 or up = 1 and down = 1").limit(1).count() == 0


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of ``links``; root is the smallest node of its component.

    Alternating large-star and small-star steps: every step is one grouped shuffle of the
    links, and the number of steps grows with the logarithm of the component size. A hub's
    neighbours are never gathered: only minima are taken per node.
    """
    edges = stored(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    )
    while not _stars(edges):
        # large star: every larger neighbour of a node is tied to the smallest of its neighbourhood
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct()
        )
        # small star: a node and its smaller neighbours are tied to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        edges = stored(
            joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(joined.select("u", F.col("m").alias("v")))
            .filter("u <> v").distinct()
        )
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
