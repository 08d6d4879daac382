"""Named queries: each reads the given tables whole and returns one DataFrame."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from briefloom.functions.text import word_tokens
from briefloom.operators import batches, encode, increments, metrics, pairs, piece_training, pieces, report
from briefloom.operators import split as splits
from briefloom.operators import summarize, validate, vocab
from briefloom.plans import prepare
from briefloom.scaling import materialise, spread
from briefloom.session import fresh_folder
from briefloom.sinks import commits
from briefloom.sinks import manifest as runs
from briefloom.sinks import npy as npy_sink
from briefloom.sinks import report as report_sink
from briefloom.sinks import sync, tables
from briefloom.sinks import zip as zip_sink
from briefloom.sources import archives, arrays, csv, csv_split, incremental, uris, zip_source
from briefloom.sources import npy_ranges as npy_source
from briefloom.sources import splits as split_source
from briefloom.streaming import ingest
from briefloom.streaming import targets as stream_sinks

# Sizes the queries and their SQL share.
VOCAB = 8_000
PIECES = 4_000
TOP_SENTENCES = 3

LANDING_SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
)


# Bytes of text that go to one CSV file: a multi-line file is read whole by one task.
CSV_FILE_BYTES = 32 << 20

# Rows that a task codes by a word vocabulary: they reach its Python in one batch, each with up to 16 kB of text.
CODED_ROWS = 1_250


def table(spark: SparkSession, sf_dir: str, name: str, **limits: int) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"), **limits)


def documents(spark: SparkSession, sf_dir: str, **limits: int) -> DataFrame:
    return table(spark, sf_dir, "documents", **limits)


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def document_pairs(spark: SparkSession, sf_dir: str, **limits: int) -> DataFrame:
    return pairs.pairs_from_documents(documents(spark, sf_dir, **limits))


def digest(ids: Column) -> Column:
    return F.md5(F.array_join(ids.cast("array<string>"), ","))


def total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda acc, x: acc + x)


def six(value: Column) -> Column:
    return F.round(value, 6)


# --- pairs and validation ---------------------------------------------------------------


def assemble_dialogue(spark, sf_dir):
    out = pairs.assemble_dialogue(conversations(spark, sf_dir))
    return out.select("id", "dialogue", F.col("n_turns").cast("long").alias("n_turns"))


def make_pairs_conv(spark, sf_dir):
    return pairs.pairs_from_turns(conversations(spark, sf_dir))


def make_pairs_docs(spark, sf_dir):
    return document_pairs(spark, sf_dir)


def select_pair_columns(spark, sf_dir):
    return pairs.select_pair_columns(documents(spark, sf_dir), "doc_id", "text", "source")


def _with_gaps(docs: DataFrame) -> DataFrame:
    """Documents with missing-value markers and blanks in three sixteenths of the rows."""
    digit = F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1)
    marked = (
        F.when(digit == "0", "NA")
        .when(digit == "1", "null")
        .when(digit == "2", "")
        .otherwise(F.col("text"))
    )
    return docs.select("doc_id", marked.alias("text"))


def na_normalise(spark, sf_dir):
    return validate.na_normalise(_with_gaps(documents(spark, sf_dir)))


def validate_pairs(spark, sf_dir):
    docs = documents(spark, sf_dir)
    gaps = docs.select(
        F.md5("text").alias("id"),
        F.when(F.col("n_chars") >= 100, F.col("text")).alias("dialogue"),
        F.when(F.col("lang") == "es", "  ").otherwise(F.col("text")).alias("summary"),
    )
    return validate.validate_pairs(gaps)


def valid_pairs(spark, sf_dir):
    return validate.valid_pairs(validate.na_normalise(_with_gaps(documents(spark, sf_dir))), ["text"])


def schema_check(spark, sf_dir):
    expected = T.StructType.fromDDL(
        "doc_id bigint, text string, lang string, source int, n_chars string, title string"
    )
    return validate.schema_check(documents(spark, sf_dir), expected)


# --- sources ----------------------------------------------------------------------------


def _address_forms(pages: DataFrame) -> DataFrame:
    url = F.col("url")
    hosted = F.regexp_replace(url, r"^https?://[^/]+/([a-z]+)/", "https://github.com/$1/blob/")
    stored = F.regexp_replace(url, "^https?://", "s3://")
    bare = F.regexp_replace(stored, "^(s3://[^/]*)/.*$", "$1")
    return pages.select("page_id", F.explode(F.array(url, hosted, stored, bare)).alias("url"))


def source_manifest(spark, sf_dir):
    return uris.source_manifest(_address_forms(table(spark, sf_dir, "pages")))


def uri_parse(spark, sf_dir):
    forms = _address_forms(table(spark, sf_dir, "pages"))
    parsed = forms.select("page_id", "url", uris.parse_uri(F.col("url")).alias("u"))
    return parsed.select("page_id", "url", "u.bucket", "u.key", "u.is_valid")


# --- splits -----------------------------------------------------------------------------


def split_exact(spark, sf_dir):
    return splits.split_exact(documents(spark, sf_dir).select("doc_id"), "doc_id")


def split_hash(spark, sf_dir):
    return splits.split_hash(documents(spark, sf_dir).select("doc_id"), "doc_id")


def split_stratified(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "lang")
    return splits.split_stratified(docs, ["lang"], "doc_id")


def shuffle_rank(spark, sf_dir):
    return splits.seeded_rank(documents(spark, sf_dir).select("doc_id"), "doc_id")


def split_manifest(spark, sf_dir):
    labelled = splits.split_exact(documents(spark, sf_dir).select("doc_id", "text"), "doc_id")
    return report.split_manifest(labelled, ["doc_id", "text"])


# --- text to features -------------------------------------------------------------------


def tokens(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", word_tokens(F.col("text")).alias("w"))
    return docs.select("doc_id", F.size("w").cast("long").alias("n_tokens"), digest(F.col("w")).alias("tokens_md5"))


def _vocab(docs: DataFrame) -> DataFrame:
    return vocab.build_vocab(docs, size=VOCAB)


def vocab_top(spark, sf_dir):
    return _vocab(documents(spark, sf_dir))


def _feature_digest(df: DataFrame, *keys: str) -> DataFrame:
    out = [*keys]
    for name in ("input_ids", "attention_mask", "labels"):
        if name in df.columns:
            out += [
                digest(F.col(name)).alias(f"{name}_md5"),
                F.size(name).cast("long").alias(f"{name}_size"),
            ]
    out.append(total(F.col("attention_mask")).alias("n_real"))
    return df.select(*out)


def encode_inputs(spark, sf_dir):
    docs = documents(spark, sf_dir, task_rows=CODED_ROWS)
    encoder = encode.word_encoder(_vocab(docs))
    coded = encode.encode_features(docs, encoder, dialogue="text", summary=None)
    return _feature_digest(coded, "doc_id")


def encode_labels(spark, sf_dir):
    docs = documents(spark, sf_dir, task_rows=CODED_ROWS)
    encoder = encode.word_encoder(_vocab(docs))
    ids = encoder(F.col("text"), encode.MAX_TARGET)
    coded = docs.select("doc_id", ids.alias("ids"))
    return coded.select(
        "doc_id",
        digest(encode.finish(F.col("ids"), encode.MAX_TARGET)).alias("labels_md5"),
        digest(encode.finish(F.col("ids"), encode.MAX_TARGET, batches.IGNORED_LABEL)).alias(
            "ignored_pad_md5"
        ),
    )


def encode_join(spark, sf_dir):
    """The path for vocabularies too large to send, with its limits turned down."""
    docs = documents(spark, sf_dir)
    rows = encode.numbered(docs)
    coded = encode.encode_by_join(rows, _vocab(docs), "text", encode.MAX_INPUT, max_rows=VOCAB // 2)
    return coded.select("doc_id", digest(encode.finish(F.col("ids"), encode.MAX_INPUT)).alias("input_ids_md5"))


def feature_table(spark, sf_dir):
    rows = document_pairs(spark, sf_dir)
    features = encode.feature_table(rows, _vocab(documents(spark, sf_dir)))
    return _feature_digest(features, "id", "split")


def _with_repeated_ids(docs: DataFrame) -> DataFrame:
    """Documents as (id, doc_id, text), ids shared by about fifty rows and null for a sixteenth."""
    digit = F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1)
    shared = F.when(digit != "0", (F.col("doc_id") % 20).cast("string"))
    return docs.select(shared.alias("id"), "doc_id", "text")


def feature_table_join(spark, sf_dir):
    """Whole feature rows by the join path, over repeated and null ids."""
    docs = documents(spark, sf_dir)
    rows = _with_repeated_ids(docs).select("id", "doc_id", F.col("text").alias("dialogue"), F.col("text").alias("summary"))
    features = encode.encode_pairs(rows, _vocab(docs), max_rows=VOCAB // 2)
    return _feature_digest(features, "id", "doc_id")


def piece_vocab(spark, sf_dir):
    return vocab.build_pieces(documents(spark, sf_dir), size=PIECES)


def encode_unigram(spark, sf_dir):
    docs = documents(spark, sf_dir)
    encoder = pieces.piece_encoder(vocab.build_pieces(docs, size=PIECES))
    coded = encode.encode_features(docs, encoder, dialogue="text", summary=None)
    return _feature_digest(coded, "doc_id")


def encode_unigram_join(spark, sf_dir):
    """The same by the path for piece tables too large to send."""
    docs = documents(spark, sf_dir)
    rows = encode.numbered(docs.select("doc_id", "text"))
    coded = pieces.encode_by_piece_join(rows, vocab.build_pieces(docs, size=PIECES), "text", encode.MAX_INPUT, "_in", max_rows=PIECES // 2)
    whole = coded.withColumns({
        "input_ids": encode.finish(F.col("_in"), encode.MAX_INPUT),
        "attention_mask": encode.attention_mask(F.col("_in"), encode.MAX_INPUT),
    })
    return _feature_digest(whole, "doc_id")


def piece_vocab_em(spark, sf_dir):
    trained = piece_training.train_pieces(documents(spark, sf_dir), size=PIECES).pieces
    return trained.select("piece", "logp", "id")


def length_profile(spark, sf_dir):
    labelled = splits.split_exact(documents(spark, sf_dir).select("doc_id", "text"), "doc_id")
    profile = encode.length_profile(labelled, "text", encode.MAX_INPUT)
    return profile.select(
        "split",
        "n_rows",
        "n_cut",
        F.col("max_tokens").cast("long").alias("max_tokens"),
        *[six(F.col(p)).alias(p) for p in ("p50", "p95", "p99")],
    )


def collate_batches(spark, sf_dir):
    rows = document_pairs(spark, sf_dir, task_rows=CODED_ROWS)
    encoder = encode.word_encoder(_vocab(documents(spark, sf_dir)))
    end = F.array(F.lit(vocab.EOS_ID))
    coded = splits.split_exact(rows, "id").select(
        "id",
        "split",
        F.concat(encoder(F.col("dialogue"), encode.MAX_INPUT), end).alias("ids"),
        F.concat(encoder(F.col("summary"), encode.MAX_TARGET), end).alias("label_ids"),
    )
    out = batches.collate_batches(coded)
    joined = {
        name: F.array_join(
            F.transform(name, lambda row: F.array_join(row.cast("array<string>"), ",")), ";"
        )
        for name in ("input_ids", "attention_mask", "labels")
    }
    return out.select(
        "split",
        "batch",
        F.array_join("ids", ",").alias("ids"),
        *[F.md5(text).alias(f"{name}_md5") for name, text in joined.items()],
    )


def map_batched(spark, sf_dir):
    def measure(columns: dict[str, list]) -> dict[str, list]:
        return {
            "n_chars": [len(text) for text in columns["text"]],
            "n_lines": [text.count("\n") + 1 for text in columns["text"]],
        }

    docs = documents(spark, sf_dir).select("doc_id", "text", "n_chars")
    return batches.map_batched(docs, measure, "n_chars bigint, n_lines bigint").select(
        "doc_id", "n_chars", "n_lines"
    )


def outline_model() -> Callable[[list], list]:
    """Stand-in for a real model that reads whole texts: first word, number of words, last word."""
    return lambda texts: [f"{w[0]} {len(w)} {w[-1]}" for w in (text.split(" ") for text in texts)]


def batch_infer(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return batches.batch_infer(docs, outline_model, "text").select("doc_id", "prediction")


# --- summaries --------------------------------------------------------------------------


def lead_k(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return summarize.lead_k(docs, TOP_SENTENCES, "text").select("doc_id", "prediction")


def tfidf_extract(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return summarize.tfidf_extract(docs, TOP_SENTENCES, "text").select(
        "doc_id", "prediction"
    )


def tfidf_extract_join(spark, sf_dir):
    """The path for idf tables too large to send, over repeated and null ids."""
    docs = _with_repeated_ids(documents(spark, sf_dir))
    return summarize.tfidf_extract(docs, TOP_SENTENCES, "text", max_rows=100).select("doc_id", "prediction")


def textrank(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return summarize.textrank(docs, TOP_SENTENCES, "text").select("doc_id", "prediction")


# --- metrics ----------------------------------------------------------------------------


def lead_predictions(spark, sf_dir) -> DataFrame:
    rows = summarize.lead_k(document_pairs(spark, sf_dir), TOP_SENTENCES)
    return rows.select("id", F.lit("lead").alias("model"), "prediction", F.col("summary").alias("reference"))


def tfidf_predictions(spark, sf_dir) -> DataFrame:
    rows = summarize.tfidf_extract(document_pairs(spark, sf_dir), TOP_SENTENCES)
    return rows.select("id", F.lit("tfidf").alias("model"), "prediction", F.col("summary").alias("reference"))


def whole_predictions(spark, sf_dir) -> DataFrame:
    """Whole texts as predictions, so that the metrics read every word."""
    rows = document_pairs(spark, sf_dir)
    return rows.select("id", F.lit("whole").alias("model"), F.col("dialogue").alias("prediction"), F.col("summary").alias("reference"))


def _rouge(name: str, rows: DataFrame) -> DataFrame:
    scored = metrics.row_metrics(rows, [name])
    return scored.select("id", *[six(F.col(name)[part]).alias(part) for part in ("p", "r", "f")])


def rouge1(spark, sf_dir):
    return _rouge("rouge1", whole_predictions(spark, sf_dir))


def rouge2(spark, sf_dir):
    return _rouge("rouge2", whole_predictions(spark, sf_dir))


def rouge_l(spark, sf_dir):
    return _rouge("rougeL", lead_predictions(spark, sf_dir))


def rouge_l_whole(spark, sf_dir):
    return _rouge("rougeL", whole_predictions(spark, sf_dir))


# Ids that are put in order by one group.
GROUP_IDS = 100


def _with_next(docs: DataFrame) -> DataFrame:
    """(id, prediction, reference): the text of the language's next document, and the own one; a language's last has no row.

    Ids are put in order within groups of ``GROUP_IDS``, each with the first document of the next group there is at its end:
    only (lang, group) pairs are put in order over a whole language.
    """
    docs = docs.select("doc_id", "lang", "text", F.floor(F.col("doc_id") / GROUP_IDS).alias("group"))
    # null ids are the first group: it has none before it
    upwards = Window.partitionBy("lang").orderBy("group")
    links = docs.select("lang", "group").distinct().withColumn("before", F.lag(F.struct("group")).over(upwards))
    firsts = docs.groupBy("lang", "group").agg(F.min(F.struct("doc_id", "text")).alias("first")).alias("f")
    heads = firsts.join(
        links.filter(F.col("before").isNotNull()).alias("l"),
        F.col("f.lang").eqNullSafe(F.col("l.lang")) & (F.col("f.group") == F.col("l.group")),
    ).select("f.first.*", "f.lang", "l.before.group", F.lit(True).alias("head"))
    inside = Window.partitionBy("lang", "group").orderBy("head", "doc_id", "text")
    rows = docs.withColumn("head", F.lit(False)).unionByName(heads).withColumn("prediction", F.lead("text").over(inside))
    kept = rows.filter(~F.col("head") & F.col("prediction").isNotNull())
    return kept.select(F.col("doc_id").cast("string").alias("id"), "prediction", F.col("text").alias("reference"))


def rouge_lsum_whole(spark, sf_dir):
    """Whole texts on both sides, line by line: each document against the next one of its language."""
    return _rouge("rougeLsum", _with_next(spark.read.parquet(f"{sf_dir}/documents.parquet")))


def rouge_lsum(spark, sf_dir):
    """Several lines on both sides: the last turn against the first lines of the dialogue."""
    rows = summarize.lead_k(
        pairs.pairs_from_turns(conversations(spark, sf_dir)), TOP_SENTENCES, joiner="\n"
    )
    return _rouge("rougeLsum", rows.withColumnRenamed("summary", "reference"))


def meteor_exact(spark, sf_dir):
    scored = metrics.row_metrics(lead_predictions(spark, sf_dir), ["meteor"])
    return scored.select("id", six(F.col("meteor")).alias("meteor"))


def bleu_corpus(spark, sf_dir):
    out = metrics.bleu_corpus(whole_predictions(spark, sf_dir))
    return out.withColumn("bleu", six(F.col("bleu")))


def meteor_whole(spark, sf_dir):
    scored = metrics.row_metrics(whole_predictions(spark, sf_dir), ["meteor"])
    return scored.select("id", six(F.col("meteor")).alias("meteor"))


def meteor_fewest(spark, sf_dir):
    """Whole texts, with the copies of repeated words paired for the fewest chunks."""
    scored = metrics.row_metrics(whole_predictions(spark, sf_dir), ["meteor"], fewest_chunks=True)
    return scored.select("id", six(F.col("meteor")).alias("meteor"))


def meteor_stems(spark, sf_dir):
    """Whole texts: equal words, then equal stems."""
    scored = metrics.row_metrics(whole_predictions(spark, sf_dir), ["meteor"], meteor_stages=[metrics.stems])
    return scored.select("id", six(F.col("meteor")).alias("meteor"))


def meteor_synonyms(spark, sf_dir):
    """Whole texts: equal words, then words of five letters or more that begin alike; the table of these is joined, not sent."""
    words = documents(spark, sf_dir).select(F.explode(word_tokens(F.col("text"))).alias("word")).distinct()
    alike = words.filter(F.length("word") >= 5).withColumn("key", F.substring("word", 1, 4))
    scored = metrics.row_metrics(whole_predictions(spark, sf_dir), ["meteor"], meteor_synonyms=alike, max_rows=0)
    return scored.select("id", six(F.col("meteor")).alias("meteor"))


SQL_METRICS = ("rouge1", "rouge2", "bleu", "meteor")


def _both_models(spark, sf_dir) -> DataFrame:
    return lead_predictions(spark, sf_dir).unionByName(tfidf_predictions(spark, sf_dir))


def evaluation_report(spark, sf_dir):
    out = metrics.evaluation_report(_both_models(spark, sf_dir), SQL_METRICS)
    return out.withColumn("value", six(F.col("value")))


def evaluation_whole(spark, sf_dir):
    """The report over whole texts."""
    out = metrics.evaluation_report(whole_predictions(spark, sf_dir), SQL_METRICS)
    return out.withColumn("value", six(F.col("value")))


def evaluation_report_full(spark, sf_dir):
    """All six metrics for the three extractive models."""
    ranked = summarize.textrank(document_pairs(spark, sf_dir), TOP_SENTENCES)
    third = ranked.select("id", F.lit("textrank").alias("model"), "prediction", F.col("summary").alias("reference"))
    out = metrics.evaluation_report(_both_models(spark, sf_dir).unionByName(third))
    return out.withColumn("value", six(F.col("value")))


def leaderboard(spark, sf_dir):
    return report.leaderboard(evaluation_report(spark, sf_dir))


# --- sinks and round trips --------------------------------------------------------------


def array_roundtrip(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    (path,) = tables.write_arrays(vectors, fresh_folder(spark, "arrays"))
    back = arrays.read_arrays(spark, path)
    squares = F.aggregate(
        "embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")
    )
    return back.select(
        "vec_id", F.size("embedding").cast("long").alias("dim"), six(F.sqrt(squares)).alias("norm")
    )


def _npy_files(vectors: DataFrame) -> DataFrame:
    """Each Arrow batch of vectors as one array file: (path, content, ids)."""
    import numpy as np

    schema = "path string, content binary, ids array<bigint>"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            buffer = io.BytesIO()
            np.save(buffer, np.stack(frame["embedding"].tolist()), allow_pickle=False)
            name = f"vectors-{frame['vec_id'].iloc[0]}.npy"
            yield pd.DataFrame(
                {"path": [name], "content": [buffer.getvalue()], "ids": [frame["vec_id"].tolist()]}
            )

    return vectors.select("vec_id", "embedding").mapInPandas(run, schema)


def npy_scan(spark, sf_dir):
    written = fresh_folder(spark, "npy")
    _npy_files(table(spark, sf_dir, "embeddings")).write.parquet(written)
    files = spark.read.parquet(written)
    vectors = arrays.npy_vectors(files)
    owners = files.select("path", F.posexplode("ids").alias("row", "vec_id"))
    return vectors.join(owners, ["path", "row"]).select(
        "vec_id",
        F.size("vector").cast("long").alias("dim"),
        six(F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x)).alias("sum"),
    )


def npy_ranges(spark, sf_dir):
    """Real array files, written by tasks and read by ranges of rows: a file is read by several tasks."""
    landed = fresh_folder(spark, "npy")
    owners = materialise(npy_sink.write_npy(table(spark, sf_dir, "embeddings"), landed, "embedding", "vec_id"))
    vectors = npy_source.read_npy_ranges(spark, landed, range_bytes=256 << 10)
    named = vectors.withColumn("name", F.regexp_extract("path", "[^/]*$", 0))
    return named.join(owners, ["name", "row"]).select(
        F.col("key").alias("vec_id"),
        F.size("vector").cast("long").alias("dim"),
        six(F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x)).alias("sum"),
    )


def csv_roundtrip(spark, sf_dir):
    docs = documents(spark, sf_dir, task_bytes=CSV_FILE_BYTES).select("doc_id", "text", F.split("text", " ").alias("words"))
    path = fresh_folder(spark, "csv")
    tables.write_csv(docs, path)
    schema = T.StructType([*LANDING_SCHEMA, T.StructField("words", T.StringType())])
    back = csv.read_csv(spark, path, schema, na_values=())
    words = F.from_json("words", "array<string>")
    return back.select("doc_id", "text", F.size(words).cast("long").alias("n_words"))


def csv_columns_by_name(spark, sf_dir):
    """Documents landed in two column orders, one with a column more, read together."""
    docs = documents(spark, sf_dir, task_bytes=CSV_FILE_BYTES).select("doc_id", "text", "lang")
    root, english = fresh_folder(spark, "orders"), F.col("lang").eqNullSafe("en")
    tables.write_csv(docs.filter(english).select("doc_id", "text"), f"{root}/a")
    tables.write_csv(docs.filter(~english).select("lang", "text", "doc_id"), f"{root}/b")
    return csv.read_csv(spark, [f"{root}/a", f"{root}/b"], LANDING_SCHEMA, na_values=())


def csv_split_large(spark, sf_dir):
    """Cells with line breaks and quotes, read back from byte ranges far smaller than the files."""
    said = F.concat(F.lit('"'), F.col("text"), F.lit('"\n'), F.col("lang"))
    path = fresh_folder(spark, "ranges")
    tables.write_csv(documents(spark, sf_dir).select("doc_id", said.alias("text")), path)
    back = csv_split.read_split_csv(spark, path, LANDING_SCHEMA, na_values=(), range_bytes=64 << 10)
    return back.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("n_chars"))


def ingest_twice(spark, sf_dir):
    """Two runs over one landing folder, more files before the second: the second reads only those."""
    base = fresh_folder(spark, "twice")
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("dialogue"), F.col("lang").alias("summary"))
    english, out = F.col("summary").eqNullSafe("en"), []
    for part in (docs.filter(english), docs.filter(~english), docs.limit(0)):
        # landing files of CSV, in folders named like files, as the run reads CSV or ZIP
        part.write.mode("append").options(**csv.CSV_OPTIONS, quoteAll="true").csv(f"{base}/landing.csv")
        run = prepare.Run(f"{base}/main", stamp=f"run{len(out)}")
        out.append(prepare.run_ingestion(spark, run, f"{base}/landing.csv", na_values=()).select("*", F.lit(len(out) + 1).alias("run")))
    both = out[0].unionByName(out[1]).unionByName(out[2])
    return both.groupBy("run").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.length("dialogue")).alias("n_chars"))


def _zip_archives(docs: DataFrame) -> DataFrame:
    """Each Arrow batch of documents as one archive: a note and two CSV members."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("readme.txt", "corpus export")
                archive.writestr("first.csv", frame.to_csv(index=False))
                archive.writestr("second.csv", frame.head(1).to_csv(index=False))
            name = f"corpus-{frame['doc_id'].iloc[0]}.zip"
            yield pd.DataFrame({"path": [name], "content": [buffer.getvalue()]})

    # as text: pandas turns the ids of a batch in which one is null into floats
    return docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(run, "path string, content binary")


def zip_ingest(spark, sf_dir):
    landed = fresh_folder(spark, "zip")
    _zip_archives(documents(spark, sf_dir)).write.parquet(landed)
    return archives.zip_csv_rows(spark.read.parquet(landed), LANDING_SCHEMA)


def zip_files_scan(spark, sf_dir):
    """Real archives, written by tasks and read by seeking, one partition each."""
    landed = fresh_folder(spark, "archives")
    docs = documents(spark, sf_dir).select("doc_id", "text")
    written = zip_sink.write_zip_csv(docs, landed, "doc_id", notes={"readme.txt": "corpus export"})
    n_rows = materialise(written).agg(F.sum("rows")).first()[0] or 0
    back = zip_source.scan_zip_files(spark, landed, LANDING_SCHEMA, na_values=())
    return back.select("doc_id", F.md5("text").alias("text_md5"), F.lit(n_rows).cast("long").alias("n_landed"))


def split_dataset_scan(spark, sf_dir):
    labelled = splits.split_exact(documents(spark, sf_dir).select("doc_id", "text"), "doc_id")
    root = tables.write_splits(labelled, fresh_folder(spark, "splits"))
    held = split_source.read_split_dataset(spark, root, "validation").unionByName(
        split_source.read_split_dataset(spark, root, "test")
    )
    return held.select("doc_id", "split", F.md5("text").alias("text_md5"))


def split_dataset_alias(spark, sf_dir):
    """A split stored under its other name is read by either."""
    labelled = splits.split_exact(documents(spark, sf_dir).select("doc_id", "text"), "doc_id")
    renamed = labelled.withColumn("split", F.when(F.col("split") == "val", "validation").otherwise(F.col("split")))
    root = tables.write_splits(renamed, fresh_folder(spark, "aliases"))
    return split_source.read_split_dataset(spark, root, "val").select("doc_id", "split", F.md5("text").alias("text_md5"))


def _by_language(spark, docs: DataFrame) -> tuple[str, DataFrame]:
    """Write documents as files by language and list those files."""
    root = fresh_folder(spark, "files")
    docs.write.partitionBy("lang").parquet(root)
    listed = incremental.list_files(spark, root, "*.parquet")
    return root, listed.withColumn("lang", F.regexp_extract("rel_path", "^lang=([a-z]+)/", 1))


def incremental_scan(spark, sf_dir):
    """Files of two languages are in the manifest already; only the others are read."""
    docs = documents(spark, sf_dir).select("doc_id", "n_chars", "lang")
    root, listed = _by_language(spark, docs)
    fresh = incremental.new_files(listed, listed.filter(F.col("lang").isin("de", "fr")))
    return incremental.read_files(spark, fresh, docs.schema, base=root).groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("n_chars").alias("n_chars")
    )


def sync_plan(spark, sf_dir):
    """Target lacks German files, has older English ones, and keeps a withdrawn copy of all."""
    docs = documents(spark, sf_dir).select("doc_id", "lang", "text")
    _, here = _by_language(spark, docs)
    older = F.when(F.col("lang") == "en", F.col("length") - 1).otherwise(F.col("length"))
    there = here.filter(F.col("lang") != "de").withColumn("length", older)
    gone = here.withColumn("rel_path", F.concat(F.lit("withdrawn/"), F.col("rel_path")))
    plan = sync.sync_plan(here, there.unionByName(gone), "backup", only_changed=True)
    lang = F.regexp_extract("key", "lang=([a-z]+)/", 1)
    folder = F.regexp_extract("key", "^(.*)/[^/]*$", 1)
    return plan.select(lang.alias("lang"), "action", folder.alias("folder")).distinct()


def sync_content(spark, sf_dir):
    """Array files of four kinds: as they are, changed in place, under another name in the target, and not there at all."""
    landed, backup = fresh_folder(spark, "here"), fresh_folder(spark, "there")
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    written, held = [], []
    for kind in range(4):
        # stored, so that both sides cut the rows into the same files
        rows = materialise(vectors.filter(F.pmod("vec_id", F.lit(4)) == kind).repartitionByRange(4, "vec_id").sortWithinPartitions("vec_id"))
        written.append(npy_sink.write_npy(rows, landed, "embedding", "vec_id"))
        there = rows
        if kind == 1:
            there = rows.withColumn("embedding", F.transform("embedding", lambda x: x + 1))
        if kind == 2:
            there = rows.withColumn("vec_id", -1 - F.col("vec_id"))
        if kind < 3:
            held.append(npy_sink.write_npy(there, backup, "embedding", "vec_id"))
    owners = materialise(reduce(DataFrame.unionByName, written))
    spare = materialise(reduce(DataFrame.unionByName, held)).filter("key < 0")
    plan = sync.sync_by_content(incremental.list_files(spark, landed), incremental.list_files(spark, backup), piece_bytes=100_000)
    renamed = F.col("origin").startswith("vectors--")
    return (
        owners.unionByName(spare).join(plan.drop("key"), F.col("name") == F.col("rel_path"))
        .select(F.col("key").alias("vec_id"), "action", F.coalesce(renamed, F.lit(False)).alias("renamed"))
    )


def multi_sink_manifest(spark, sf_dir):
    labelled = splits.split_exact(documents(spark, sf_dir, task_bytes=CSV_FILE_BYTES).select("doc_id", "text"), "doc_id")
    base, stamp = fresh_folder(spark, "run"), runs.run_stamp()

    def path(target: str) -> str:
        return runs.run_path(base, stamp, "data_transformation", target)

    written = tables.write_targets(
        labelled,
        [
            tables.Target("parquet", path("parquet"), "parquet", ("split",)),
            tables.Target("csv", path("csv"), "csv", ("split",)),
            tables.Target("backup", path("backup"), "parquet", enabled=False),
        ],
    )
    artifacts = [
        runs.Artifact(stamp, "data_transformation", "splits", name, uri)
        for name, uri in written.items()
    ]
    manifest = runs.append_manifest(spark, f"{base}/manifest", artifacts)
    schema = T.StructType([*LANDING_SCHEMA, T.StructField("split", T.StringType())])
    rows = spark.read.parquet(written["parquet"]).select("split", F.lit("parquet").alias("target"))
    text = csv.read_csv(spark, written["csv"], schema).select("split", F.lit("csv").alias("target"))
    counts = rows.unionByName(text).groupBy("target", "split").agg(F.count(F.lit(1)).alias("n_rows"))
    return manifest.select("stage", "artifact", "target", F.col("uri").isNotNull().alias("written")).join(
        counts, "target", "left"
    )


def multi_sink_commit(spark, sf_dir):
    """Two versions of two targets, each committed as one step; readers see the last one whole."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    base = fresh_folder(spark, "published")
    targets = [
        tables.Target("parquet", f"{base}/parquet", "parquet", ("lang",)),
        tables.Target("csv", f"{base}/csv", "csv"),
        tables.Target("backup", f"{base}/backup", enabled=False),
    ]
    for version, rows in (("v1", docs.filter("lang = 'en'")), ("v2", docs)):
        commits.publish(spark, f"{base}/log", version, [(rows, targets)])
    names = ("parquet", "csv")
    parts = [
        commits.read_published(spark, f"{base}/log", name).select(
            "doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), "lang", F.lit(name).alias("target"), "version"
        )
        for name in names
    ]
    return parts[0].unionByName(parts[1])


def vocab_incremental(spark, sf_dir):
    """Counts of two landings, the second on top of the first."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    root, listed = _by_language(spark, docs)
    store = fresh_folder(spark, "counts")
    for landed in (listed.filter(F.col("lang").isin("de", "fr")), listed):
        increments.add_counts(spark, store, landed, lambda files: incremental.read_files(spark, files, docs.schema, base=root))
    return vocab.vocab_of_counts(increments.stored_counts(spark, store), VOCAB)


def report_roundtrip(spark, sf_dir):
    labelled = splits.split_exact(documents(spark, sf_dir).select("doc_id", "text"), "doc_id")
    counted = report.split_manifest(labelled, ["text"]).unpivot(
        "split", ["num_examples", "num_bytes"], "metric", "value"
    )
    path = report_sink.write_report(counted, fresh_folder(spark, "report"))
    return spark.read.schema("split string, metric string, value bigint").json(path)


# --- streams ----------------------------------------------------------------------------


def stream_ingest(spark, sf_dir):
    """Two landings into one folder, ingested by two runs of the same stream."""
    landing, target, state = (fresh_folder(spark, n) for n in ("landing", "ingested", "state"))
    docs = documents(spark, sf_dir, task_bytes=CSV_FILE_BYTES).select("doc_id", "text", "lang")
    english = F.col("lang").eqNullSafe("en")
    for part in (docs.filter(english), docs.filter(~english)):
        tables_out = tables.flat_columns(part.select("doc_id", "text"))
        tables_out.write.mode("append").options(header="true", quote='"', escape='"').csv(landing)
        out = ingest.stream_ingest(spark, landing, target, state, LANDING_SCHEMA)
    return out


def stream_targets(spark, sf_dir):
    """Files with columns in either order go to two targets; rows whose id is no number are set aside."""
    landing, base, state = (fresh_folder(spark, n) for n in ("landing", "streamed", "state"))
    docs = documents(spark, sf_dir, task_bytes=CSV_FILE_BYTES).select("doc_id", "text")
    outputs = stream_sinks.Outputs(
        [tables.Target("parquet", f"{base}/parquet"), tables.Target("csv", f"{base}/csv", "csv")],
        tables.Target("quarantine", f"{base}/quarantine"), f"{base}/log",
    )
    named = F.when(F.col("doc_id") % 10 == 0, F.concat(F.lit("no:"), "doc_id")).otherwise(F.col("doc_id").cast("string"))
    rows = docs.withColumn("doc_id", named)
    for part in (rows.filter(docs["doc_id"] % 2 == 0), rows.filter(docs["doc_id"] % 2 == 1).select("text", "doc_id")):
        part.write.mode("append").options(**csv.CSV_OPTIONS, quoteAll="true").csv(landing)
        stream_sinks.start_targets(spark, landing, outputs, state, LANDING_SCHEMA, max_files=100).awaitTermination()
    good = [
        stream_sinks.read_target(spark, outputs, name).select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), F.lit(name).alias("target"))
        for name in ("parquet", "csv")
    ]
    bad = stream_sinks.read_target(spark, outputs, "quarantine").select(
        F.regexp_extract("record", 'no:([0-9]+)', 1).cast("long").alias("doc_id"),
        F.lit(None).cast("string").alias("text_md5"), F.lit("quarantine").alias("target"),
    )
    return good[0].unionByName(good[1]).unionByName(bad)


def stream_features(spark, sf_dir):
    landing, target, state = (fresh_folder(spark, n) for n in ("landing", "features", "state"))
    rows = document_pairs(spark, sf_dir, task_bytes=CSV_FILE_BYTES)
    tables.write_csv(rows, landing)
    encoder = encode.word_encoder(_vocab(documents(spark, sf_dir)))
    out = ingest.stream_features(spark, landing, target, state, encoder)
    return _feature_digest(out, "id", "split")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "select_pair_columns": select_pair_columns,
    "assemble_dialogue": assemble_dialogue,
    "make_pairs_conv": make_pairs_conv,
    "make_pairs_docs": make_pairs_docs,
    "na_normalise": na_normalise,
    "validate_pairs": validate_pairs,
    "valid_pairs": valid_pairs,
    "schema_check": schema_check,
    "source_manifest": source_manifest,
    "uri_parse": uri_parse,
    "split_exact": split_exact,
    "split_hash": split_hash,
    "split_stratified": split_stratified,
    "shuffle_rank": shuffle_rank,
    "split_manifest": split_manifest,
    "word_tokens": tokens,
    "vocab_top": vocab_top,
    "encode_inputs": encode_inputs,
    "encode_labels": encode_labels,
    "encode_join": encode_join,
    "feature_table": feature_table,
    "feature_table_join": feature_table_join,
    "piece_vocab": piece_vocab,
    "encode_unigram": encode_unigram,
    "encode_unigram_join": encode_unigram_join,
    "piece_vocab_em": piece_vocab_em,
    "length_profile": length_profile,
    "collate_batches": collate_batches,
    "map_batched": map_batched,
    "batch_infer": batch_infer,
    "lead_k": lead_k,
    "tfidf_extract": tfidf_extract,
    "tfidf_extract_join": tfidf_extract_join,
    "textrank": textrank,
    "rouge1": rouge1,
    "rouge2": rouge2,
    "rougeL": rouge_l,
    "rougeL_whole": rouge_l_whole,
    "rougeLsum_whole": rouge_lsum_whole,
    "rougeLsum": rouge_lsum,
    "meteor_exact": meteor_exact,
    "bleu_corpus": bleu_corpus,
    "evaluation_report": evaluation_report,
    "evaluation_report_full": evaluation_report_full,
    "leaderboard": leaderboard,
    "array_roundtrip": array_roundtrip,
    "npy_scan": npy_scan,
    "npy_ranges": npy_ranges,
    "csv_roundtrip": csv_roundtrip,
    "csv_columns_by_name": csv_columns_by_name,
    "csv_split_large": csv_split_large,
    "ingest_twice": ingest_twice,
    "split_dataset_alias": split_dataset_alias,
    "zip_ingest": zip_ingest,
    "zip_files_scan": zip_files_scan,
    "split_dataset_scan": split_dataset_scan,
    "incremental_scan": incremental_scan,
    "sync_plan": sync_plan,
    "sync_content": sync_content,
    "multi_sink_manifest": multi_sink_manifest,
    "multi_sink_commit": multi_sink_commit,
    "vocab_incremental": vocab_incremental,
    "stream_targets": stream_targets,
    "meteor_whole": meteor_whole,
    "meteor_fewest": meteor_fewest,
    "meteor_stems": meteor_stems,
    "meteor_synonyms": meteor_synonyms,
    "evaluation_whole": evaluation_whole,
    "report_roundtrip": report_roundtrip,
    "stream_ingest": stream_ingest,
    "stream_features": stream_features,
}
