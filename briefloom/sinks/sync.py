"""What a directory upload would do, worked out from two file listings."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from briefloom.scaling import materialise, one_task_each
from briefloom.sources.zip_source import open_file

PIECE_BYTES = 64 << 20
READ_BYTES = 1 << 20


def _key(prefix: str, rel_path: Column) -> Column:
    start = f"{prefix.strip('/')}/" if prefix.strip("/") else ""
    return F.concat(F.lit(start), rel_path)


def sync_plan(
    source: DataFrame, target: DataFrame, prefix: str = "", only_changed: bool = False
) -> DataFrame:
    """(rel_path, key, action) for listings with ``rel_path``, ``length`` and ``modified``.

    Every source file is uploaded: ``copy`` where the target lacks it, ``replace`` where
    it exists (``same`` instead, with ``only_changed``, if lengths are equal and
    the source has not changed since). Files that
    exist in the target alone are ``extra`` and stay.
    """
    here = source.select("rel_path", F.col("length").alias("_here"), F.col("modified").alias("_since"))
    there = target.select("rel_path", F.col("length").alias("_there"), F.col("modified").alias("_copied"))
    unchanged = (F.col("_here") == F.col("_there")) & (F.col("_since") <= F.col("_copied")) & F.lit(only_changed)
    return here.join(there, "rel_path", "full_outer").select(
        "rel_path",
        _key(prefix, F.col("rel_path")).alias("key"),
        F.when(F.col("_there").isNull(), "copy")
        .when(F.col("_here").isNull(), "extra")
        .when(unchanged, "same")
        .otherwise("replace")
        .alias("action"),
    )


def digests(listing: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """(path, digest): SHA-256 over the SHA-256 of each piece in order, so a large file is read by many tasks.

    ``listing`` has ``path`` and ``length``; a file that is shorter by now is an error. Digests of different ``piece_bytes`` differ.
    """
    pieces = listing.select("path", "length").distinct().withColumn(
        "start", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(piece_bytes).cast("long")))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path, length, start in zip(*(c.to_pylist() for c in batch.columns)):
                held, left = hashlib.sha256(), min(piece_bytes, length - start)
                with open_file(path) as file:
                    file.seek(start)
                    while left:
                        read = file.read(min(READ_BYTES, left))
                        if not read:
                            raise ValueError(f"a file is shorter than it was listed: {path}")
                        held.update(read)
                        left -= len(read)
                out.append(held.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(out, pa.string())], ["path", "start", "piece"])

    dealt = one_task_each(materialise(pieces.select("path", "length", "start")), "path", "start")
    read = dealt.mapInArrow(run, "path string, start long, piece string")
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("start", "piece"))), lambda p: p["piece"])
    return read.groupBy("path").agg(F.sha2(F.array_join(in_order, ""), 256).alias("digest"))


def sync_by_content(source: DataFrame, target: DataFrame, prefix: str = "", piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """(rel_path, key, action, origin) as ``sync_plan``, decided by what the files hold.

    For listings with ``path``, ``rel_path`` (unique in each) and ``length``. A file that is in both places is ``same`` or ``replace``;
    one that the target lacks is a ``duplicate`` of ``origin`` (the key of a file under another name, found by digest: renamed
    or copied files are not sent again) or else a ``copy``. ``extra`` files exist in the target alone, stay, and are
    the only origins, as other files may be replaced. Only files whose length decides nothing are read. Spark's listings
    leave out empty files.
    """
    here = source.select("rel_path", F.col("path").alias("_here"), F.col("length").alias("_size"))
    there = target.select("rel_path", F.col("path").alias("_there"), F.col("length").alias("_held"))
    both = materialise(here.join(there, "rel_path", "full_outer"))
    lacking, spare = both.filter("_there is null"), both.filter("_here is null")
    alike = both.filter("_size = _held")
    sizes = lacking.select(F.col("_size").alias("length")).intersect(spare.select(F.col("_held").alias("length")))
    candidates = lacking.select(F.col("_here").alias("path"), F.col("_size").alias("length")).unionByName(
        spare.select(F.col("_there").alias("path"), F.col("_held").alias("length"))
    )
    read = (
        alike.select(F.col("_here").alias("path"), F.col("_size").alias("length"))
        .unionByName(alike.select(F.col("_there").alias("path"), F.col("_held").alias("length")))
        .unionByName(candidates.join(sizes, "length", "left_semi").select("path", "length"))
    )
    known = materialise(digests(read, piece_bytes))
    named = both
    for side in ("_here", "_there"):
        named = named.join(known.select(F.col("path").alias(side), F.col("digest").alias(f"_digest{side}")), side, "left")
    origins = named.filter("_here is null").groupBy(F.col("_digest_there").alias("_digest_here")).agg(F.min("rel_path").alias("_origin"))
    planned = named.join(origins, "_digest_here", "left")
    lacks = F.col("_there").isNull()
    return planned.select(
        "rel_path",
        _key(prefix, F.col("rel_path")).alias("key"),
        F.when(lacks & F.col("_origin").isNotNull(), "duplicate")
        .when(lacks, "copy")
        .when(F.col("_here").isNull(), "extra")
        .when(F.col("_digest_here") == F.col("_digest_there"), "same")
        .otherwise("replace")
        .alias("action"),
        F.when(lacks, _key(prefix, F.col("_origin"))).alias("origin"),
    )
