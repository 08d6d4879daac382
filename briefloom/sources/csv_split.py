"""Multi-line CSV files read by many tasks each.

Spark's text source cuts a file into byte ranges at line ends, but a line end inside quotes ends no
record. In a file that doubles the quotes inside its cells, a place is inside a cell's quotes just if an
odd number of quotes lies before it. So each range counts its quotes, a running sum over the ranges
of a file tells each how it begins, and every range parses the records that begin in it.
What is left at its ends (the rest of a record that began before, the beginning of one that goes on) is put
together by record: a few short rows for each range.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from briefloom.operators.validate import NA_VALUES
from briefloom.scaling import MAX_BROADCAST_ROWS, materialise, row_count_at_most
from briefloom.sources.csv import CORPUS_SCHEMA, header_names

CHUNK_ROWS = 2_000
TASK_BYTES = 16 << 20  # of ranges that one task reads
CELL_LIMIT = 2**31 - 1  # the csv module's own is 128 kB
# What a piece of a record that spans ranges is in its range: the end of one that began before, all
# of it inside one, or the beginning of one that goes on.
HEAD, WHOLE, TAIL = 0, 1, 2


def quotes_in(column):
    return F.length(column) - F.length(F.replace(column, F.lit('"'), F.lit("")))


def ranges_of(spark: SparkSession, paths: Sequence[str], range_bytes: int | None = None) -> DataFrame:
    """(path, start, range, inside, header) of every byte range that begins a line: whether it begins
    inside quotes, and the first line of its file. One pass over the lines, without Python; a row for
    each range is shuffled."""
    lines = _lines(spark, paths, range_bytes).withColumn("at", F.monotonically_increasing_id())
    first = F.min_by(F.when(F.col("start") == 0, F.col("value")), "at")
    counted = lines.groupBy("path", "start").agg(F.sum(quotes_in(F.col("value"))).alias("quotes"), first.alias("first"))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    header = F.first("first", ignorenulls=True).over(Window.partitionBy("path"))
    return materialise(
        counted.select("path", "start", inside.alias("inside"), F.regexp_replace(header, "\r$", "").alias("header"))
        .withColumn("range", F.monotonically_increasing_id())
    )


def _lines(spark: SparkSession, paths: Sequence[str], range_bytes: int | None = None) -> DataFrame:
    """Lines with their range. A task takes ranges one after the other, ``TASK_BYTES`` of them: each task reports to the
    driver, so that there must not be one for every small range."""
    lines = spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value"
    )
    if range_bytes and range_bytes < TASK_BYTES:
        n = lines.rdd.getNumPartitions()
        tasks = max(-(-n * range_bytes // TASK_BYTES), min(n, 2 * spark.sparkContext.defaultParallelism))
        lines = lines.coalesce(tasks) if tasks < n else lines
    return lines


def records(lines: Iterator[str], pending: list[str]) -> Iterator[list[str]]:
    """Records of the lines; ``pending`` holds the lines of the record given last."""
    csv.field_size_limit(CELL_LIMIT)

    def fed():
        for line in lines:
            pending.append(line)
            yield line + "\n"

    for row in csv.reader(fed()):
        yield row
        pending.clear()


def _odd(lines: Sequence[str]) -> bool:
    return sum(line.count('"') for line in lines) % 2 == 1


def pieces_of(lines: Iterator[str], inside: bool) -> list[tuple[int, str]]:
    """What a range holds of records that do not lie in it whole."""
    found, taken, opening = [], [], inside
    for line in lines:
        taken.append(line)
        inside ^= line.count('"') % 2 == 1
        if not inside:
            if opening:
                found.append((HEAD, "\n".join(taken)))
                opening = False
            taken = []
    if inside:
        found.append((WHOLE if opening else TAIL, "\n".join(taken)))
    return found


def records_of(lines: Iterator[str], inside: bool, first: bool) -> Iterator[list[str]]:
    """The records that lie in a range whole; ``first``: the first record is the file's header."""
    for line in lines if inside else ():
        inside ^= line.count('"') % 2 == 1
        if not inside:
            break
    if inside:
        return
    pending: list[str] = []
    found = records(lines, pending)
    if first:
        next(found, None)
    for row in found:
        if row and not _odd(pending):
            yield row


def by_range(batches) -> Iterator[tuple[tuple, Iterator[str]]]:
    """((range, start, inside, layout), its lines) of one range after the other."""
    rows = chain.from_iterable(zip(*(column.to_pylist() for column in b.columns)) for b in batches)
    for head, own in groupby(rows, key=lambda r: r[:4]):
        if head[3] is None:
            raise ValueError("the byte ranges have changed since their quotes were counted: read the files again")
        yield head, (r[4] for r in own)


def _batch(rows: list[tuple], kinds: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, kinds)], [n for n, _ in kinds])


class _Layout:
    """Places of the wanted columns in files with one header."""

    def __init__(self, header: str, names: list[str], missing: set[str]):
        own = header_names(header)
        lacking = [n for n in names if n not in own]
        if header.count('"') % 2 or lacking or len(set(own)) != len(own):
            raise ValueError(f"columns {lacking or own} missing or repeated in the header {header[:200]!r}")
        self.size, self.places, self.missing = len(own), [own.index(n) for n in names], missing

    def cells(self, row: list[str]) -> list[str | None]:
        if len(row) != self.size:
            raise ValueError(f"{len(row)} cells instead of {self.size} in the record {str(row)[:200]}")
        return [None if row[p] in self.missing else row[p] for p in self.places]


def _pieces(lines: DataFrame) -> DataFrame:
    kinds = [("range", pa.int64()), ("piece", pa.int32()), ("text", pa.string())]

    def run(batches):
        for (number, _, inside, _), own in by_range(batches):
            yield _batch([(number, *piece) for piece in pieces_of(own, inside)], kinds)

    return lines.mapInArrow(run, "range long, piece int, text string")


def _records(lines: DataFrame, layouts: list[_Layout], cells: list[str]) -> DataFrame:
    kinds = [(c, pa.string()) for c in cells]

    def run(batches):
        held: list[list] = []
        for (_, start, inside, layout), own in by_range(batches):
            for row in records_of(own, inside, start == 0):
                held.append(layouts[layout].cells(row))
                if len(held) == CHUNK_ROWS:
                    yield _batch(held, kinds)
                    held = []
        yield _batch(held, kinds)

    return lines.mapInArrow(run, ", ".join(f"{c} string" for c in cells))


def _joined(pieces: DataFrame, ranges: DataFrame) -> DataFrame:
    """(layout, text) of the records that span ranges.

    The ranges' order says which pieces belong together: a TAIL begins a record, pieces up to the next TAIL are its own.
    Only numbers are ordered by file; texts go to their record's task.
    """
    placed = pieces.select("range", "piece").join(ranges.select("range", "path", "start"), "range")
    order = Window.partitionBy("path").orderBy("start", "piece")
    numbered = placed.withColumn("record", F.sum((F.col("piece") == TAIL).cast("long")).over(order))
    texts = numbered.join(pieces, ["range", "piece"]).join(ranges.select("range", "layout"), "range")
    whole = texts.groupBy("path", "record").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "piece", "text"))), lambda p: p["text"]), "\n").alias("text"),
        F.first("layout").alias("layout"), F.sum((F.col("piece") != WHOLE).cast("int")).alias("ends"),
    )
    open_ = F.raise_error(F.concat(F.lit("quotes are not closed in "), F.col("path")))
    return whole.select("layout", F.when(F.col("ends") < 2, open_.cast("string")).otherwise(F.col("text")).alias("text"))


def read_split_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | str = CORPUS_SCHEMA,
    na_values: Sequence[str] = NA_VALUES,
    range_bytes: int | None = None,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Rows of header CSV files whose cells may hold line breaks, in as many tasks as their bytes ask for.

    Columns go by the names in each file's header line; a file that lacks one, a row with too few or
    too many cells, a cell that is not of its column's type and quotes that are never closed are errors.
    Quotes inside a quoted cell are doubled; a cell that is not quoted holds none. Line ends
    inside cells stay as they are; records end in ``\\n`` or ``\\r\\n``. Lines without cells are no
    records. ``range_bytes`` (default: the session's ``spark.sql.files.maxPartitionBytes``) is the size of a range; small ranges share a task. The lines
    are read twice: to count quotes and to parse. The table of ranges, one row each, is broadcast
    when counted to be small; beyond that lines are brought together by range.
    """
    given = [paths] if isinstance(paths, str) else list(paths)
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if range_bytes:
        own = spark.newSession()  # the result keeps its settings
        for name, value in spark.conf.getAll.items():
            if spark.conf.isModifiable(name):
                own.conf.set(name, value)
        spark = own
        spark.conf.set("spark.sql.files.maxPartitionBytes", range_bytes)
        spark.conf.set("spark.sql.files.openCostInBytes", min(range_bytes, 4 << 20))
    names = schema.fieldNames()
    ranges = ranges_of(spark, given, range_bytes)
    headers = [r["header"] for r in ranges.select("header").distinct().orderBy("header").collect()]
    layouts = [_Layout(h or "", names, set(na_values)) for h in headers]
    known = spark.createDataFrame([(h, i) for i, h in enumerate(headers)], "header string, layout int")
    ranges = materialise(ranges.join(F.broadcast(known), "header").drop("header"))  # one row a header

    lines = _lines(spark, given, range_bytes)
    if row_count_at_most(ranges, max_broadcast_rows):
        lines = lines.join(F.broadcast(ranges), ["path", "start"], "left")
    else:
        at = lines.withColumn("_at", F.monotonically_increasing_id()).join(ranges, ["path", "start"], "left")
        lines = at.repartition("path", "start").sortWithinPartitions("path", "start", "_at")
    lines = lines.select("range", "start", "inside", "layout", "value")
    cells = [f"c{i}" for i in range(len(names))]
    spanning = _joined(materialise(_pieces(lines)), ranges)

    def parse(batches):
        for b in batches:
            rows = [
                layouts[layout].cells(row)
                for layout, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for row in records(iter([text]), [])
            ]
            yield _batch(rows, [(c, pa.string()) for c in cells])

    rows = _records(lines, layouts, cells).unionByName(spanning.mapInArrow(parse, ", ".join(f"{c} string" for c in cells)))
    return rows.select(*[_typed(c, f) for c, f in zip(cells, schema)])


def _typed(cell: str, field: T.StructField):
    if isinstance(field.dataType, T.StringType):
        return F.col(cell).alias(field.name)
    value = F.col(cell).try_cast(field.dataType)
    wrong = F.raise_error(F.concat(F.lit(f"not a {field.dataType.simpleString()} in column {field.name}: "), F.col(cell)))
    return F.when(F.col(cell).isNotNull() & value.isNull(), wrong.cast(field.dataType)).otherwise(value).alias(field.name)
