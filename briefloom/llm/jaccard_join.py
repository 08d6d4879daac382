"""N-gram Jaccard join by vertical partitioning: exact links and their components.

1. Texts with equal shingle sets are one *class*; only one text of each class goes on.
2. The number of classes that hold a shingle is counted (``exchange``), and sorts the shingles
   of the corpus into one global order: rare first, then by hash. A class of ``n`` shingles of
   which ``u`` occur elsewhere can reach similarity t with a class of size ``m`` only if
   min(u, u') >= t / (1 + t) * (n + m); most classes drop out here, exactly.
3. Two classes that link share a shingle among their first ``n - ceil(t n) + 1``. In each such
   list of classes, every member is first paired with the list's most central member; what that
   leaves in one component needs no further pair. Members outside the list's largest
   component are paired with those of other components if sizes and positions allow a link.
4. The order is cut into fragments. A pair's overlap is counted in each fragment on its own
   and the partial counts are summed per pair.
5. Links join classes to components; every row gets the smallest id of its component.

No step pairs the members of a list that already hang together, and none drops a pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from briefloom.llm import exchange
from briefloom.llm.helpers import components, stored
from briefloom.llm.kernels import Words, mix, slices

REMEMBERED = 200_000
# members of a list that meet its outsiders in one task
LIST_PART = 20_000
CLASSES = (
    "sig string, n long, u long, central double, prefix array<struct<token:long,pos:int>>, "
    "segments array<array<long>>"
)


def _text_column(column) -> pa.Array:
    column = column.cast(pa.large_string())
    if isinstance(column, pa.ChunkedArray):
        return pa.concat_arrays(column.chunks) if column.num_chunks != 1 else column.chunk(0)
    return column


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted different shingle hashes of each text; A-Z count as a-z. Short texts: one shingle."""
    out = []
    for i, j in slices(texts):
        words = Words(texts.slice(i, j - i), fold_case=True)
        at, hashes = words.windows(width)
        cuts = np.searchsorted(at, words.bounds)
        whole = words.whole()
        for k, n in enumerate(words.counts):
            if n >= width:
                out.append(np.unique(hashes[cuts[k] : cuts[k + 1]]))
            else:
                out.append(whole[k : k + 1] if n else whole[:0])
    return out


def signature(shingles: np.ndarray) -> str | None:
    """128 bits of a shingle set, the same whatever the order; None for an empty set."""
    if not len(shingles):
        return None
    a = int(np.add.reduce(mix(shingles ^ np.uint64(0x5851F42D4C957F2D))))
    b = int(np.add.reduce(mix(shingles + np.uint64(0x14057B7EF767814F))))
    return f"{a:016x}{b:016x}"


def _level(counts: np.ndarray) -> np.ndarray:
    """Count to a byte that keeps the order: exact up to 64, then eight steps an octave."""
    high = 64 + 8 * np.log2(np.maximum(counts, 64) / 64)
    return np.minimum(np.where(counts <= 64, counts, high), 255).astype(np.uint8)


def _fragment(level: np.ndarray, tokens: np.ndarray, fragments: int) -> np.ndarray:
    """Vertical partition of a shingle: half of the fragments for the rare levels, half for the rest."""
    half = max(1, fragments // 2)
    part = (tokens >> np.uint64(40)) % np.uint64(half)
    return np.where(level <= 2, part, half % fragments + part).astype(np.int64) % fragments


def signatures(
    docs: DataFrame, width: int, ident: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """(doc_id, sig, n_shingles, columns ``carry``) of every row; sig is null for a text without words."""

    def run(batches):
        for batch in batches:
            sets = shingle_sets(_text_column(batch.column(1)), width)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([signature(s) for s in sets], pa.string()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    *batch.columns[2:],
                ],
                ["doc_id", "sig", "n_shingles", *carry],
            )

    kinds = dict(docs.dtypes)
    rows = docs.select(
        F.col(ident).cast("long").alias("_id"), F.col(text).cast("string").alias("_text"), *carry
    )
    return rows.mapInArrow(run, ", ".join(["doc_id long, sig string, n_shingles long", *(f"{c} {kinds[c]}" for c in carry)]))


def _class_texts(docs: DataFrame, width: int, text: str) -> DataFrame:
    """(sig, text), each class once per task, as long as the task remembers it: hot texts are sent seldom."""

    def run(batches):
        seen: set[str] = set()
        for batch in batches:
            column = _text_column(batch.column(0))
            sigs = [signature(s) for s in shingle_sets(column, width)]
            first = sorted({s: i for i, s in reversed(list(enumerate(sigs))) if s is not None and s not in seen}.values())
            seen.update(sigs[i] for i in first)
            if len(seen) > REMEMBERED:
                seen.clear()
            yield pa.RecordBatch.from_arrays(
                [pa.array([sigs[i] for i in first], pa.string()), column.take(pa.array(first, pa.int64())).cast(pa.string())],
                ["sig", "text"],
            )

    return docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "sig string, text string")


def candidates(docs: DataFrame, width: int, percent: int, fragments: int, text: str = "text") -> DataFrame:
    """Classes that can link at all, with prefix shingles and the shingles of each fragment."""
    blocks, buckets = exchange.sizes(exchange.total_bytes(docs.select(F.col(text).cast("string").alias(text)), text))
    blocked = _class_texts(docs, width, text).withColumn("block", exchange.block_of(["sig"], blocks))

    def classes(group: pa.Table) -> dict[str, np.ndarray]:
        sigs = group["sig"].to_pylist()
        first = list({s: i for i, s in reversed(list(enumerate(sigs)))}.values())
        sets = shingle_sets(_text_column(group["text"].take(pa.array(first, pa.int64()))), width)
        return dict(zip([sigs[i] for i in first], sets))

    def keys(group: pa.Table):
        values, counts = np.unique(np.concatenate(list(classes(group).values())), return_counts=True)
        return values, np.minimum(counts, 255)

    def select(texts: pa.Table, answers: pa.Table) -> pa.Table:
        own = classes(texts)
        values = np.unique(np.concatenate(list(own.values())))
        levels = exchange.read_answers(answers, values, buckets)
        rows = []
        for sig, tokens in own.items():
            n, level = len(tokens), levels[np.searchsorted(values, tokens)]
            u = int((level > 1).sum())
            need = -(-percent * n // 100)
            if (100 + percent) * u < percent * (n + need):  # not even with its smallest partner
                continue
            order = np.lexsort((tokens, level))[n - u :]
            ranked, level = tokens[order], level[order]
            first = ranked[: max(0, n - need + 1 - (n - u))].view(np.int64)
            part = _fragment(level, ranked, fragments)
            rows.append(
                {
                    "sig": sig,
                    "n": n,
                    "u": u,
                    "central": float(level.astype(np.int64).sum() / n),
                    "prefix": [{"token": int(t), "pos": n - u + i} for i, t in enumerate(first)],
                    "segments": [ranked[part == f].view(np.int64).tolist() for f in range(fragments)],
                }
            )
        kind = pa.schema(
            [
                ("sig", pa.string()), ("n", pa.int64()), ("u", pa.int64()), ("central", pa.float64()),
                ("prefix", pa.list_(pa.struct([("token", pa.int64()), ("pos", pa.int32())]))),
                ("segments", pa.list_(pa.list_(pa.int64()))),
            ]
        )
        return pa.Table.from_pylist(rows, kind)

    counted = exchange.count_hashes(blocked, keys, _level, buckets)
    return blocked.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(select, CLASSES)


def _may_link(percent: int):
    """Size, shared-part and position bounds on the overlap of two prefix entries ``a`` and ``b``."""
    need = F.lit(percent) * (F.col("a.n") + F.col("b.n"))
    more = F.lit(100 + percent)
    return (
        (F.lit(100) * F.least("a.n", "b.n") >= F.lit(percent) * F.greatest("a.n", "b.n"))
        & (more * F.least("a.u", "b.u") >= need)
        & (more * F.least(F.col("a.n") - F.col("a.pos"), F.col("b.n") - F.col("b.pos")) >= need)
    )


def verified(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, a_n, b_n) that link: overlaps counted per fragment, then summed per pair."""
    of_a = segments.select(F.col("sig").alias("a"), "fragment", F.col("tokens").alias("a_tokens"))
    of_b = segments.select(F.col("sig").alias("b"), "fragment", F.col("tokens").alias("b_tokens"))
    partial = (
        pairs.join(of_b, "b")
        .join(of_a, ["a", "fragment"])
        .select("a", "b", "a_n", "b_n", F.size(F.array_intersect("a_tokens", "b_tokens")).alias("shared"))
    )
    total = partial.groupBy("a", "b", "a_n", "b_n").agg(F.sum("shared").alias("shared"))
    return total.filter((100 + percent) * F.col("shared") >= percent * (F.col("a_n") + F.col("b_n")))


def _outsiders(entries: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` of entries of one list in different components, each pair once.

    Of two components at least one is not the list's largest, so members outside the largest (``a``)
    meet the whole list, and members of the largest are never paired. Long lists are dealt into
    salted parts, and their outsiders copied to each.
    """
    sizes = entries.groupBy("token", "root").agg(F.count(F.lit(1)).alias("m"))
    lists = sizes.groupBy("token").agg(
        F.max_by("root", F.struct("m", "root")).alias("main"),
        F.ceil(F.sum("m") / F.lit(LIST_PART)).cast("int").alias("parts"),
    )
    known = stored(entries.join(lists, "token"))
    outside = known.filter("root <> main").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    whole = known.withColumn("part", F.pmod(F.xxhash64("sig"), F.col("parts")).cast("int"))
    once = (F.col("b.root") == F.col("b.main")) | (F.col("a.root") < F.col("b.root"))
    return outside.alias("a").join(whole.alias("b"), ["token", "part"]).filter((F.col("a.root") != F.col("b.root")) & once)


def links(classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(links, components) of the candidate classes: enough links to join what hangs together."""
    segments = classes.select("sig", F.posexplode("segments").alias("fragment", "tokens")).filter(F.size("tokens") > 0)
    # every candidate class in at most n - ceil(t n) + 1 lists
    entries = stored(
        classes.select("sig", "n", "u", "central", F.explode("prefix").alias("p")).select(
            "sig", "n", "u", "central", "p.token", "p.pos"
        )
    )
    shape = ["a.sig as a", "b.sig as b", "a.n as a_n", "b.n as b_n"]
    pivots = entries.groupBy("token").agg(
        F.max_by(F.struct("sig", "n", "u", "pos"), F.struct("central", "sig")).alias("p"), F.count(F.lit(1)).alias("m")
    ).filter("m > 1").select("token", "p.*")
    hub = (
        entries.alias("a").join(pivots.alias("b"), "token")
        .filter((F.col("a.sig") != F.col("b.sig")) & _may_link(percent))
        .selectExpr(*shape).distinct()
    )
    found = stored(verified(hub, segments, percent).select("a", "b"))
    parts = stored(components(found, "a", "b"))
    # lists that still hold more than one component
    placed = entries.join(parts, F.col("sig") == F.col("node"), "left").withColumn("root", F.coalesce("root", "sig"))
    mixed = placed.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi")
    open_entries = stored(placed.join(mixed.select("token"), "token", "left_semi").drop("node", "central"))
    across = _outsiders(open_entries).filter(_may_link(percent)).selectExpr(*shape).distinct()
    more = stored(verified(across, segments, percent).select("a", "b"))
    every = found.unionByName(more)
    return every, components(every, "a", "b")


def similar_groups(
    docs: DataFrame, width: int = 5, percent: int = 80, ident: str = "doc_id", text: str = "text", fragments: int = 4
) -> DataFrame:
    """(doc_id, sig, n_shingles, root) for every row: ``root`` names the component of its text.

    See ``jaccard_join``. ``sig`` names the shingle set; both are null for a text without words.
    """
    signed = stored(signatures(docs, width, ident, text))
    _, parts = links(stored(candidates(docs, width, percent, fragments, text)), percent)
    # one row a class; only classes with a link are in ``parts``
    roots = signed.filter("sig is not null").select("sig").distinct().join(parts, F.col("sig") == F.col("node"), "left")
    of_class = roots.select("sig", F.coalesce("root", "sig").alias("root"))
    return signed.join(of_class, "sig", "left").select("doc_id", "sig", "n_shingles", "root")


def jaccard_join(
    docs: DataFrame, width: int = 5, percent: int = 80, ident: str = "doc_id", text: str = "text", fragments: int = 4
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    Rows link when 100 * |A & B| >= percent * |A | B| for their sets of ``width``-word shingles
    (A-Z as a-z; a text with fewer words is one shingle). ``component_id`` is the smallest id
    that links reach. A text without words (or null) has no shingle, links with nothing and is
    its own component. Rows with a null id take part, and get the smallest non-null id of
    their component, if it has one. Repeated rows share a component. Columns of ``docs`` other
    than id and text are not read.
    """
    signed = stored(signatures(docs, width, ident, text))
    _, parts = links(stored(candidates(docs, width, percent, fragments, text)), percent)
    # one row a class, so that copies are shuffled once; only classes with a link are in ``parts``
    least = signed.filter("sig is not null").groupBy("sig").agg(F.min("doc_id").alias("least"))
    placed = least.join(parts, F.col("sig") == F.col("node"), "left").withColumn("root", F.coalesce("root", "sig"))
    roots = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = placed.join(roots, "root").select("sig", "component_id")
    return signed.join(of_class, "sig", "left").select(
        "doc_id", "n_shingles", F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def keep_first(docs: DataFrame, width: int = 5, percent: int = 80, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the one with the smallest id.

    Rows are told apart by id and shingles, null ids come last, and of rows alike in both the first
    by text stays. Rows without words are all kept. Columns are those of ``docs``.
    """
    columns = docs.columns
    groups = similar_groups(docs, width, percent, ident, text).filter("sig is not null")
    first = F.min_by(F.struct("doc_id", "sig"), F.struct(F.col("doc_id").isNull(), "doc_id", "sig"))
    # component sizes do not matter: minima are taken before the shuffle
    chosen = groups.groupBy("root").agg(first.alias("f")).select(F.col("f.doc_id").alias("id_"), F.col("f.sig").alias("sig_"))
    carried = docs.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(columns)])
    at = {c: f"_{i}" for i, c in enumerate(columns)}
    rows = signatures(carried, width, at[ident], at[text], tuple(carried.columns))
    wordless = rows.filter("sig is null")
    named = rows.filter("sig is not null").join(
        chosen, (F.col("sig") == F.col("sig_")) & F.col("doc_id").eqNullSafe(F.col("id_")), "left_semi"
    )
    one = named.groupBy("sig", "doc_id").agg(
        F.min_by(F.struct(*carried.columns), F.struct(F.md5(F.col(at[text]).cast("binary")), F.to_json(F.struct(*[c for c in carried.columns if c != at[text]])))).alias("r")
    ).select("r.*")
    every = one.unionByName(wordless.select(*carried.columns))
    return every.select(*[F.col(at[c]).alias(c) for c in columns])


def op9_jaccard_join(docs: DataFrame) -> DataFrame:
    return jaccard_join(docs, width=4, percent=85)
