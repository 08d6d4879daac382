"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Every source is a queue of its documents in a seeded shuffle, followed by the same documents
in a second shuffle where its target is above its size. A queued copy's virtual finish time
is the source's words up to and including it, divided by the source's target. All copies are
range-sorted by finish time, and the sorted stream is cut at the total budget; the copy in
which a source reaches its target is cut there, so that no long document moves a share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from briefloom.llm.helpers import WORD, running_total, running_totals, stored
from briefloom.scaling import MAX_BROADCAST_ROWS, row_count_at_most

WEIGHTS = (3, 1, 2)
# equal rows are numbered in stretches of this many, so that no task or array holds them all
STRETCH = 100_000


def words_in(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, repeats: int = 2) -> DataFrame:
    """(source, source_size, weight, target, queue) from (source, source_size).

    Sources in code point order (null last) are numbered (``queue``) and take ``weights`` in turn. A
    target is at most ``repeats`` times its source's size; what is above goes to the others by weight, until
    none is above. In order of size per weight the full sources come first, so running sums find
    the level: that of the first source that does not fill up. However many sources there are,
    sums run range by range, and only totals reach the driver.
    """
    named = sizes.withColumns({"_null": F.col("source").isNull(), "_one": F.lit(1).cast("long")})
    numbered = running_total(named, ["_null", "source"], "_one", "queue")
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("queue") - 1, F.lit(len(weights))).cast("int") + 1)
    weighted = stored(
        numbered.withColumn("weight", weight.cast("long")).withColumn("most", F.col("source_size") * repeats)
        .withColumn("fill", F.col("most") / F.col("weight"))
    )
    whole = weighted.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    order = ["fill", "weight", "_null", "source"]
    summed = running_totals(weighted, order, {"full": "most", "used": "weight"})
    rest = F.lit(whole["weight"] or 0) - (F.col("used") - F.col("weight"))
    level = (F.lit(float(whole["size"] or 0) * share) - (F.col("full") - F.col("most")).cast("double")) / rest
    fits = summed.withColumn("level", level).filter(F.col("level") * F.col("weight") <= F.col("most"))
    found = fits.agg(F.min_by("level", F.struct(*order))).first()[0]
    target = F.col("most").cast("double")
    if found is not None:
        target = F.least(F.lit(found) * F.col("weight"), target)
    return weighted.select("source", "source_size", "weight", target.alias("target"), "queue")


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.5,
    repeats: int = 2,
    seed: int = 17,
    ident: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The mixed stream: (doc_id, source, size, source_size, target, epoch, taken, position, shuffle, content).

    One row for every copy the mix takes words of, and one (``epoch`` 0, taken 0) for every row
    of ``docs``, so that rows left out are seen too. ``position`` is the number of words before the
    copy in the stream. Null and empty texts have size 0 and are never taken; a source
    without words has target 0; a null source is a source; rows with equal ids and texts are
    rows of their own and interchangeable (``content``, a hash of the text, tells others with one id
    apart). The same rows give the same result whatever
    their order or partitioning. Columns besides the three are not read.
    """
    rows = stored(
        docs.select(
            F.col(ident).cast("long").alias("doc_id"),
            F.col(source).cast("string").alias("source"),
            words_in(text).alias("size"),
            F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("digest"),
        ).withColumn("content", F.xxhash64("digest"))
    )
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    copies_of = F.ceil(F.col("target") / F.col("source_size"))
    length = F.when(F.col("source_size") > 0, F.col("source_size") * copies_of).otherwise(0).cast("long")
    # a row per source: its target, and the words of the queues before its own
    numbered = running_total(
        targets(per_source, weights, share, repeats).withColumn("_length", length), ["queue"], "_length", "_upto"
    )
    numbered = stored(numbered.withColumn("_start", F.col("_upto") - F.col("_length")).drop("weight", "_length", "_upto"))
    few = row_count_at_most(numbered, MAX_BROADCAST_ROWS)
    known = rows.join(
        F.broadcast(numbered) if few else numbered,
        rows["source"].eqNullSafe(numbered["source"]),
    ).drop(numbered["source"])
    epochs = F.sequence(F.lit(1), copies_of.cast("int"))
    copies = known.filter("size > 0").withColumn("epoch", F.explode(epochs)).withColumn(
        "shuffle", F.md5(F.concat_ws(":", F.lit(str(seed)), "epoch", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "digest"))
    )
    # position of a copy in its source's queue: the running total over all queues, less the queues before
    queued = running_total(
        copies.select("doc_id", "source", "queue", "_start", "size", "source_size", "target", "epoch", "shuffle", "content"),
        ["queue", "epoch", "shuffle", "doc_id"], "size", "_total",
    )
    finish = (
        queued
        .withColumn("_upto", F.col("_total") - F.col("_start"))
        .withColumn("finish", F.least(F.lit(1.0), F.col("_upto") / F.col("target")))
        # what of the copy lies below its source's target
        .withColumn(
            "taken",
            F.greatest(
                F.lit(0).cast("long"),
                F.least(F.col("size"), F.floor("target") - (F.col("_upto") - F.col("size"))),
            ),
        )
        .filter("taken > 0")
        .select("doc_id", "source", "size", "source_size", "target", "epoch", "taken", "finish", "queue", "shuffle", "content")
    )
    budget = F.lit(per_source.agg(F.sum("source_size")).first()[0] or 0) * F.lit(share)
    stream = (
        running_total(finish, ["finish", "queue", "epoch", "shuffle", "doc_id"], "taken", "_end")
        .withColumn("position", F.col("_end") - F.col("taken"))
        .withColumn("taken", F.least("taken", F.floor(budget) - F.col("position")))
        .filter("taken > 0")
    )
    shape = ["doc_id", "source", "size", "source_size", "target", "epoch", "taken", "position"]
    untaken = known.withColumns(
        {"epoch": F.lit(0), "taken": F.lit(0).cast("long"), "position": F.lit(None).cast("long")}
    )
    return stream.select(*shape, "shuffle", "content").unionByName(
        untaken.select(*shape, F.lit(None).cast("string").alias("shuffle"), "content")
    )


def words_by_row(mixed: DataFrame, repeats: int = 2) -> DataFrame:
    """(doc_id, size, source_size, target, taken): a row for every row that was mixed, from ``mix_sources``.

    The words taken of rows equal in id, source and text are dealt to these rows copy by copy: each gets
    one whole copy before any gets a second, and none more than ``repeats`` times its size. Rows
    that share an id, or have none, but differ in text or source are kept apart.
    """
    alike = mixed.groupBy("doc_id", "source", "size", "content").agg(
        F.first("source_size").alias("source_size"), F.first("target").alias("target"),
        F.sum("taken").alias("words"), F.count_if(F.col("epoch") == 0).alias("rows"),
    )
    counted = stored(alike)
    # more equal rows than one stretch: each stretch is a row of its own before it is unfolded
    many = counted.filter(F.col("rows") > STRETCH).withColumn(
        "from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1, F.lit(STRETCH).cast("long")))
    ).repartition("doc_id", "content", "from")
    few = counted.filter(F.col("rows") <= STRETCH).withColumn("from", F.lit(0).cast("long"))
    last = F.least(F.col("rows"), F.col("from") + STRETCH) - 1
    numbered = few.unionByName(many).withColumn("k", F.explode(F.sequence("from", last)))
    none = F.lit(0).cast("long")
    rounds = [
        F.greatest(none, F.least(F.col("size"), F.col("words") - (F.col("rows") * n + F.col("k")) * F.col("size")))
        for n in range(repeats)
    ]
    return numbered.select("doc_id", "size", "source_size", "target", sum(rounds[1:], rounds[0]).alias("taken"))


def op1_mix_sources(docs: DataFrame) -> DataFrame:
    """Words taken of every row; rows with repeated or null ids are rows of their own."""
    return words_by_row(mix_sources(docs))
