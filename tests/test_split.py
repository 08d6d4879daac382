from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from briefloom.operators.split import (
    SplitRatios,
    seeded_rank,
    shuffle_seeded,
    split_exact,
    split_hash,
    split_stratified,
)
from briefloom.scaling import spread

# n -> (train, val, test), worked out by hand from two-stage rounding up.
SIZES = {
    0: (0, 0, 0), 1: (0, 0, 1), 2: (1, 0, 1), 5: (4, 0, 1), 7: (5, 1, 1), 10: (8, 1, 1),
    11: (8, 1, 2), 100: (80, 10, 10), 819: (655, 82, 82), 14732: (11785, 1473, 1474),
}


def sizes(df):
    counts = {r["split"]: r["n"] for r in df.groupBy("split").agg(F.count("*").alias("n")).collect()}
    return tuple(counts.get(s, 0) for s in ("train", "val", "test"))


@pytest.mark.parametrize("n", list(SIZES))
def test_sizes(spark, n):
    assert sizes(split_exact(spark.range(n).toDF("id"), "id")) == SIZES[n]


def test_partitioning_does_not_matter(spark):
    ids = spark.range(1000).toDF("id")
    results = [
        {r["id"]: r["split"] for r in split_exact(ids.repartition(n), "id").collect()}
        for n in (1, 7)
    ]
    assert results[0] == results[1] and len(results[0]) == 1000


def test_seed_changes_members_not_sizes(spark):
    ids = spark.range(1000).toDF("id")
    one, two = (split_exact(ids, "id", SplitRatios(seed=s)) for s in (1, 2))
    assert sizes(one) == sizes(two)
    assert one.join(two, ["id", "split"]).count() < 1000


def test_other_ratios_and_string_ids(spark):
    ids = spark.range(200).select(F.concat(F.lit("row-"), "id").alias("id"))
    assert sizes(split_exact(ids, "id", SplitRatios(0.5, 0.25, 0.25))) == (100, 50, 50)


def test_stratified_sizes_with_a_hot_and_a_null_stratum(spark):
    rows = spark.range(1000).select(
        "id",
        F.when(F.col("id") < 700, "hot").when(F.col("id") < 970, "warm").alias("kind"),
    )
    labelled = split_stratified(rows, ["kind"])
    for kind, n in (("hot", 700), ("warm", 270), (None, 30)):
        held = math.ceil((1.0 - 0.8) * n)
        test = math.ceil(0.5 * held)
        part = labelled.filter(F.col("kind").eqNullSafe(F.lit(kind)))
        assert sizes(part) == (n - held, held - test, test)


@pytest.mark.parametrize("share", [0.05, 0.34, 0.95])
def test_sizes_stay_exact_with_a_hot_id(spark, share):
    """One id holds up to nearly all rows, and every other id comes three times."""
    n = 3000
    rows = spark.range(n).select(
        F.when(F.col("id") < int(n * share), -1).otherwise(F.floor(F.col("id") / 3)).alias("id"),
        F.col("id").alias("row"),
    )
    for seed in range(3):
        labelled = split_exact(rows, "id", SplitRatios(seed=seed))
        assert sizes(labelled) == (2400, 300, 300)
        assert labelled.select("row").distinct().count() == n


def test_only_identical_rows(spark):
    rows = spark.range(1000).select(F.lit("same").alias("id"), F.lit("text").alias("t"))
    assert sizes(split_exact(rows)) == (800, 100, 100)
    kinds = spark.range(1000).select(F.lit("same").alias("id"), (F.col("id") % 2).alias("k"))
    labelled = split_stratified(kinds, ["k"])
    assert sizes(labelled.filter("k = 0")) == sizes(labelled.filter("k = 1")) == (400, 50, 50)


def test_hash_split_is_stable_as_rows_arrive(spark):
    few = {r["id"]: r["split"] for r in split_hash(spark.range(500).toDF("id")).collect()}
    many = {r["id"]: r["split"] for r in split_hash(spark.range(5000).toDF("id")).collect()}
    assert all(many[i] == s for i, s in few.items())
    shares = sizes(split_hash(spark.range(5000).toDF("id")))
    assert abs(shares[0] - 4000) < 120 and abs(shares[1] - 500) < 90 and abs(shares[2] - 500) < 90


def test_rank_is_the_shuffled_order(spark):
    ids = spark.range(777).toDF("id")
    ordered = [r["id"] for r in shuffle_seeded(ids).collect()]
    ranks = {r["id"]: r["rank"] for r in seeded_rank(ids.repartition(5)).collect()}
    assert [ranks[i] for i in ordered] == list(range(1, 778))
    assert ordered != sorted(ordered)


def test_rank_within_groups(spark):
    rows = spark.range(600).select("id", F.when(F.col("id") < 500, "hot").otherwise("cold").alias("g"))
    ranked = seeded_rank(rows, within=["g"])
    by_group = {r["g"]: sorted(r["ranks"]) for r in ranked.groupBy("g").agg(F.collect_list("rank").alias("ranks")).collect()}
    assert by_group == {"hot": list(range(1, 501)), "cold": list(range(1, 101))}


def test_a_file_with_one_row_group_is_dealt_to_many_tasks(spark, tmp_path):
    spark.range(1_000).coalesce(1).write.parquet(str(tmp_path / "one"))
    table = spark.read.parquet(str(tmp_path / "one"))
    dealt = spread(table, small=10, task_rows=50)
    assert dealt.rdd.getNumPartitions() == 20 and dealt.agg(F.sum("id")).first()[0] == 499_500
    assert spread(table, small=10, task_rows=1_000).rdd.getNumPartitions() == 1


def test_pieces_that_hold_no_rows_do_not_count(spark, tmp_path):
    spark.range(2_000).withColumn("text", F.sha2(F.col("id").cast("string"), 512)).coalesce(1).write.parquet(str(tmp_path / "one"))
    session = spark.newSession()  # one row group, far more byte ranges than it asks for
    session.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    session.conf.set("spark.sql.files.openCostInBytes", "1k")
    table = session.read.parquet(str(tmp_path / "one"))
    assert table.rdd.getNumPartitions() > 20
    dealt = spread(table, small=10, task_rows=100)
    assert max(rows_by_piece(dealt)) <= 110 and sum(rows_by_piece(dealt)) == 2_000
    assert spread(table, small=10_000).rdd.getNumPartitions() >= table.rdd.getNumPartitions()


def test_wide_rows_are_dealt_by_their_bytes(spark):
    table = spark.range(400).select("id", F.repeat(F.lit("word "), 2_000).alias("text")).repartition(2)
    assert spread(table).rdd.getNumPartitions() == 8
    for small in (10, 1_000):
        dealt = spread(table, small=small, task_bytes=100_000)
        assert dealt.rdd.getNumPartitions() == 40 and max(rows_by_piece(dealt)) <= 15
    assert spread(table, small=10, task_bytes=4_000_000).rdd.getNumPartitions() == 2


def rows_by_piece(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
