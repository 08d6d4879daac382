"""Seeded train / val / test splits.

Rows are ordered by ``md5(id:seed)``, then id. An exact split needs two cut points in
that order, not the order itself: a histogram of the key's leading digits finds the two
buckets that hold the cuts, only those buckets are ranked, and every row is then
labelled by comparing its own key with the cuts. The wide columns are never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from briefloom.functions.ordering import hex_prefix, order_key, unit_interval
from briefloom.scaling import MAX_BROADCAST_ROWS, materialise, row_count_at_most

# Hex digits of the key per histogram bucket: at most 65,536 buckets per stratum, so a running
# sum over the buckets of one stratum is small whatever the table's size.
HISTOGRAM_DIGITS = 4


@dataclass(frozen=True)
class SplitRatios:
    # The default ratios and seed.
    train: float = 0.8
    val: float = 0.1
    test: float = 0.1
    seed: int = 42

    @property
    def holdout(self) -> float:
        return 1.0 - self.train

    @property
    def test_share(self) -> float:
        return self.test / (self.test + self.val)

    def holdout_rows(self, n: Column) -> Column:
        return F.ceil(F.lit(self.holdout) * n)

    def test_rows(self, n: Column) -> Column:
        return F.ceil(F.lit(self.test_share) * self.holdout_rows(n))


def _cut_points(
    df: DataFrame, id_col: str, strata: Sequence[str], ratios: SplitRatios
) -> DataFrame:
    """Per stratum the ids at which the test rows and the held-out rows end.

    ``_test`` and ``_holdout`` are structs (at, take, copies): the (key, id) reached, how
    many of its rows are still inside, and how many rows it has.
    """
    strata = list(strata)
    keys = df.select(
        *strata, order_key(F.col(id_col), ratios.seed).alias("_key"), F.col(id_col).alias("_id")
    ).withColumn("_bucket", hex_prefix(F.col("_key"), HISTOGRAM_DIGITS))
    histogram = keys.groupBy(*strata, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy(*strata) if strata else Window.partitionBy(F.lit(0))
    running = whole.orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    counted = histogram.withColumns(
        {"_upto": F.sum("_rows").over(running), "_n": F.sum("_rows").over(whole)}
    )
    wanted = F.explode(
        F.array(
            F.struct(F.lit("test").alias("cut"), ratios.test_rows(F.col("_n")).alias("rank")),
            F.struct(F.lit("holdout").alias("cut"), ratios.holdout_rows(F.col("_n")).alias("rank")),
        )
    )
    before = F.col("_upto") - F.col("_rows")
    cut_buckets = (
        counted.select(*strata, "_bucket", "_upto", before.alias("_before"), wanted.alias("_w"))
        .filter((F.col("_w.rank") > F.col("_before")) & (F.col("_w.rank") <= F.col("_upto")))
        .select(
            *[F.col(s).alias(f"_s{i}") for i, s in enumerate(strata)],
            F.col("_bucket").alias("_cut_bucket"),
            F.col("_w.cut").alias("_cut"),
            (F.col("_w.rank") - F.col("_before")).alias("_rank_in_bucket"),
        )
    )
    if not strata:
        # One bucket per cut: two rows at most.
        cut_buckets = F.broadcast(cut_buckets)
    else:
        cut_buckets = materialise(cut_buckets)
        if row_count_at_most(cut_buckets, MAX_BROADCAST_ROWS):
            cut_buckets = F.broadcast(cut_buckets)
    same = F.col("_bucket") == F.col("_cut_bucket")
    for i, s in enumerate(strata):
        same = same & F.col(s).eqNullSafe(F.col(f"_s{i}"))
    # Rows are counted per id first (map side): copies of one id never meet in one task.
    owners = [f"_s{i}" for i, _ in enumerate(strata)]
    ids = (
        keys.join(cut_buckets, same)
        .groupBy(*owners, "_cut", "_rank_in_bucket", "_key", "_id")
        .agg(F.count(F.lit(1)).alias("_copies"))
    )
    upto = F.sum("_copies").over(
        Window.partitionBy(*owners, "_cut")
        .orderBy("_key", "_id")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    take = F.col("_rank_in_bucket") - (F.col("_upto") - F.col("_copies"))
    reached = (
        ids.withColumn("_upto", upto)
        .withColumn("_take", take)
        .filter((F.col("_take") > 0) & (F.col("_take") <= F.col("_copies")))
    )
    entry = F.struct(
        F.struct("_key", "_id").alias("at"),
        F.col("_take").alias("take"),
        F.col("_copies").alias("copies"),
    )
    return reached.groupBy(*owners).agg(
        F.max(F.when(F.col("_cut") == "test", entry)).alias("_test"),
        F.max(F.when(F.col("_cut") == "holdout", entry)).alias("_holdout"),
    )


def _attach_cuts(
    df: DataFrame, id_col: str, strata: Sequence[str], ratios: SplitRatios
) -> tuple[DataFrame, bool]:
    """Add the cut structs to every row; also whether some cut falls between copies."""
    cuts = _cut_points(df, id_col, strata, ratios)
    torn = F.lit(False)
    for c in ("_test", "_holdout"):
        torn = torn | F.coalesce(F.col(c)["take"] < F.col(c)["copies"], F.lit(False))
    if strata:
        cuts = materialise(cuts)
        any_torn = bool(cuts.agg(F.bool_or(torn)).first()[0])
        if row_count_at_most(cuts, MAX_BROADCAST_ROWS):
            cuts = F.broadcast(cuts)
        same = F.lit(True)
        for i, s in enumerate(strata):
            same = same & F.col(s).eqNullSafe(F.col(f"_s{i}"))
        return df.join(cuts, same, "left"), any_torn
    # Two cuts for the whole table: they become constants of the plan.
    types = {f.name: f.dataType for f in cuts.schema}
    found = cuts.select("_test", "_holdout", torn.alias("torn")).first()

    def constant(name: str) -> Column:
        cut = found[name] if found else None
        if cut is None:
            return F.lit(None).cast(types[name])
        at = F.struct(F.lit(cut["at"]["_key"]).alias("_key"), F.lit(cut["at"]["_id"]).alias("_id"))
        return F.struct(
            at.alias("at"), F.lit(cut["take"]).alias("take"), F.lit(cut["copies"]).alias("copies")
        ).cast(types[name])

    with_cuts = df.withColumns({n: constant(n) for n in ("_test", "_holdout")})
    return with_cuts, bool(found and found["torn"])


def split_exact(
    df: DataFrame,
    id_col: str = "id",
    ratios: SplitRatios = SplitRatios(),
    strata: Sequence[str] = (),
) -> DataFrame:
    """Add ``split``; sizes are exact (per stratum), also when ids repeat.

    Only if a cut falls between the copies of one id are those rows stored, numbered and
    ranked among themselves; all others are labelled where they lie.
    """
    marked, torn = _attach_cuts(df, id_col, strata, ratios)
    here = F.struct(
        order_key(F.col(id_col), ratios.seed).alias("_key"), F.col(id_col).alias("_id")
    )

    def holds(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False))

    def upto(cut: str) -> Column:
        return holds(here <= F.col(cut)["at"])

    label = F.when(upto("_test"), "test").when(upto("_holdout"), "val").otherwise("train")
    columns = [*df.columns, "split"]
    if not torn:
        return marked.withColumn("split", label).select(columns)

    def at_torn(cut: str) -> Column:
        c = F.col(cut)
        return holds((here == c["at"]) & (c["take"] < c["copies"]))

    between = at_torn("_test") | at_torn("_holdout")
    apart = marked.filter(~between).withColumn("split", label)
    copies = materialise(marked.filter(between)).withColumn(
        "_copy", F.monotonically_increasing_id()
    )
    turn = seeded_rank(copies, "_copy", ratios.seed, [*strata, id_col], "_turn")

    def inside(cut: str) -> Column:
        c = F.col(cut)
        return upto(cut) & holds((here != c["at"]) | (F.col("_turn") <= c["take"]))

    ranked = turn.withColumn(
        "split", F.when(inside("_test"), "test").when(inside("_holdout"), "val").otherwise("train")
    )
    return apart.select(columns).unionByName(ranked.select(columns))


def split_stratified(
    df: DataFrame, strata: Sequence[str], id_col: str = "id", ratios: SplitRatios = SplitRatios()
) -> DataFrame:
    return split_exact(df, id_col, ratios, strata)


def split_hash(
    df: DataFrame, id_col: str = "id", ratios: SplitRatios = SplitRatios()
) -> DataFrame:
    """Row-local split: sizes are approximate, membership never changes as rows arrive."""
    u = unit_interval(order_key(F.col(id_col), ratios.seed))
    val_end = ratios.train + ratios.holdout * (1.0 - ratios.test_share)
    return df.withColumn(
        "split",
        F.when(u < F.lit(ratios.train), "train").when(u < F.lit(val_end), "val").otherwise("test"),
    )


def seeded_rank(
    df: DataFrame,
    id_col: str = "id",
    seed: int = 42,
    within: Sequence[str] = (),
    name: str = "rank",
) -> DataFrame:
    """Exact 1-based position of every row in the seeded order (per ``within`` group).

    Ids must be unique (``validate_pairs`` counts repeats).

    The position is the row's place in its own key bucket plus the rows in earlier
    buckets. The buckets are even whatever the data looks like, so a group holding most
    rows is still ranked by thousands of tasks.
    """
    within = list(within)
    keyed = df.withColumn("_key", order_key(F.col(id_col), seed)).withColumn(
        "_bucket", hex_prefix(F.col("_key"), HISTOGRAM_DIGITS)
    )
    histogram = (
        df.select(*within, hex_prefix(order_key(F.col(id_col), seed), HISTOGRAM_DIGITS).alias("_b"))
        .groupBy(*within, "_b")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    whole = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    running = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = materialise(
        histogram.select(
            *[F.col(w).alias(f"_w{i}") for i, w in enumerate(within)],
            "_b",
            (F.sum("_rows").over(running) - F.col("_rows")).alias("_before"),
        )
    )
    if row_count_at_most(offsets, MAX_BROADCAST_ROWS):
        offsets = F.broadcast(offsets)
    same = F.col("_bucket") == F.col("_b")
    for i, w in enumerate(within):
        same = same & F.col(w).eqNullSafe(F.col(f"_w{i}"))
    place = F.row_number().over(Window.partitionBy(*within, "_bucket").orderBy("_key", id_col))
    return (
        keyed.withColumn("_place", place)
        .join(offsets, same, "left")
        .withColumn(name, F.col("_before") + F.col("_place"))
        .select(*df.columns, name)
    )


def shuffle_seeded(df: DataFrame, id_col: str = "id", seed: int = 42) -> DataFrame:
    """The rows in seeded order (range-partitioned sort; partitioning-independent)."""
    return df.orderBy(order_key(F.col(id_col), seed), F.col(id_col))
