"""Size-checked building blocks: stored intermediates, lookups, and top rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from briefloom.session import shared_folder

# A broadcast side is limited by rows and bytes measured before it is sent.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 256 << 20


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and continue from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def string_bytes(df: DataFrame) -> Column:
    """Bytes of a row's strings."""
    width = F.lit(0)
    for name, kind in df.dtypes:
        if kind in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(name), F.lit(0))
    return width


def row_count_at_most(df: DataFrame, limit: int, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Size check of a table before it is sent: rows, and bytes of its strings.

    One distributed count with a sum of lengths; meant for materialised tables.
    """
    width = F.lit(8 * len(df.columns)) + string_bytes(df)
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= limit and size <= max_bytes


# Rows of a text table that one task takes, and the most tasks a table is dealt to.
TASK_ROWS = 5_000
MOST_TASKS = 10_000


def spread(df: DataFrame, small: int = 200_000, task_rows: int = TASK_ROWS, task_bytes: int | None = None) -> DataFrame:
    """Use every core for a table of which some piece holds more than a task should take.

    The rows are counted by piece, which Parquet answers from its footers. A *small* table gets as many pieces as the
    session has partitions, and any table a piece for every ``task_rows`` rows: a file is cut only between its row groups,
    which may hold most of a table while other pieces are empty. ``task_bytes`` asks for a piece for so many bytes of
    strings as well, which takes a pass over them. What a task takes at a time so does not grow with the table. A
    table is not dealt to fewer pieces than it lies in, and one without such a piece is returned as it is.
    """
    width = string_bytes(df) if task_bytes else F.lit(0)
    pieces = df.groupBy(F.spark_partition_id().alias("_piece")).agg(F.count(F.lit(1)).alias("_rows"), F.sum(width).alias("_size"))
    rows, size, most_rows, most_size = (
        x or 0 for x in pieces.agg(F.sum("_rows"), F.sum("_size"), F.max("_rows"), F.max("_size")).first()
    )
    wanted = max(-(-rows // task_rows), -(-size // task_bytes) if task_bytes else 0)
    parts = max(min(MOST_TASKS, wanted), df.rdd.getNumPartitions())
    if rows <= small:
        parts = max(parts, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        return df.repartition(parts)
    return df.repartition(parts) if most_rows > task_rows or task_bytes and most_size > task_bytes else df


def heaviest(
    table: DataFrame, size: int, weight: str, name: str, max_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """The ``size`` rows with the largest integer ``weight``, ties by ``name``.

    A plain top-k keeps up to ``size`` rows per task and merges them all in one task. On a
    large table the weight of the last kept row is therefore found first, from the number
    of rows per weight, and everything lighter is dropped where it lies. Pass a
    materialised table.
    """
    if not row_count_at_most(table, max_rows):
        # One row per different weight: few, as N occurrences have at most sqrt(2N) of them.
        downwards = Window.partitionBy(F.lit(0)).orderBy(F.desc(weight))
        levels = table.groupBy(weight).agg(F.count(F.lit(1)).alias("_rows"))
        last = (
            levels.withColumn("_upto", F.sum("_rows").over(downwards))
            .filter(F.col("_upto") >= size)
            .agg(F.max(weight).alias("w"))
            .first()["w"]
        )
        if last is not None:
            table = table.filter(F.col(weight) >= last)
    return table.orderBy(F.desc(weight), F.asc(name)).limit(size)


def left_lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    max_rows: int = MAX_BROADCAST_ROWS,
    hot_rows: int = 100_000,
) -> DataFrame:
    """Left join of ``rows`` to a lookup ``table`` with one row per ``key``.

    A table measured to be small is broadcast. Beyond that, the keys that most ``rows`` have, known
    to the table or not, are looked up by a broadcast of ``hot_rows`` entries at most, so no hot
    key is shuffled; the rest is joined by shuffle. Rows without a key find nothing and are not
    moved. Pass materialised tables: ``rows`` are counted by key first.
    """
    if row_count_at_most(table, max_rows):
        return rows.join(F.broadcast(table), key, "left")
    used = materialise(rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_uses")))
    hot_keys = heaviest(used, hot_rows, "_uses", key, max_rows).select(key)
    hot = materialise(hot_keys.join(table, key, "left"))
    common = rows.join(F.broadcast(hot), key, "inner")
    rare = rows.filter(F.col(key).isNotNull()).join(F.broadcast(hot.select(key)), key, "left_anti")
    none = rows.filter(F.col(key).isNull())
    for field in table.schema:
        if field.name != key:
            none = none.withColumn(field.name, F.lit(None).cast(field.dataType))
    return common.unionByName(rare.join(table, key, "left")).unionByName(none)


def one_task_each(rows: DataFrame, *keys: str, most: int = 100_000) -> DataFrame:
    """Deals rows that each stand for much work (a piece of a file, say) to as many tasks as there are rows, up to ``most``.

    ``rows`` is counted, so it should be stored. A plain ``repartition`` by columns would be undone: Spark joins partitions
    of few bytes, and such rows are small.
    """
    return rows.repartition(max(1, min(rows.count(), most)), *keys)
