"""What the plans must and must not hold: shuffles, scanned columns, pruned folders."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from briefloom.operators import encode, metrics, pairs, split, summarize, validate, vocab
from briefloom.sinks.tables import write_splits
from briefloom.sources.splits import read_split_dataset

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df) -> int:
    return len(re.findall(r"\bExchange\b", plan(df)))


def scanned(df) -> set[str]:
    return set(re.findall(r"(\w+):", " ".join(re.findall(r"ReadSchema: struct<([^>]*)>", plan(df)))))


def test_row_local_operators_do_not_shuffle(docs):
    rows = pairs.pairs_from_documents(docs)
    predictions = summarize.lead_k(rows).withColumnRenamed("summary", "reference")
    encoder = encode.word_encoder(vocab.build_vocab(docs, size=500))
    for frame in (
        rows,
        predictions,
        summarize.textrank(rows),
        summarize.tfidf_extract(rows),
        split.split_exact(docs, "doc_id"),
        split.split_hash(docs, "doc_id"),
        encode.encode_features(split.split_exact(rows), encoder),
        metrics.row_metrics(predictions),
    ):
        assert shuffles(frame) == 0, plan(frame)


def test_stratified_split_joins_by_broadcast_only(docs):
    labelled = split.split_stratified(docs, ["lang"], "doc_id")
    assert "BroadcastHashJoin" in plan(labelled) and "BroadcastNestedLoopJoin" not in plan(labelled)
    assert shuffles(labelled) == 0


def test_metrics_shuffle_only_sums(docs):
    rows = pairs.pairs_from_documents(docs)
    predictions = summarize.lead_k(rows).select(
        F.lit("m").alias("model"), "prediction", F.col("summary").alias("reference")
    )
    report = metrics.evaluation_report(predictions)
    assert shuffles(report) == 1 and "CartesianProduct" not in plan(report)
    assert plan(report).count("ArrowEvalPython") <= 2


def test_scans_read_only_what_is_used(docs):
    assert scanned(vocab.word_counts(docs)) == {"text"}
    assert scanned(split.split_hash(docs.select("doc_id"), "doc_id")) == {"doc_id"}
    assert scanned(validate.validate_pairs(docs, "doc_id", ["text"])) == {"doc_id", "text"}
    assert scanned(pairs.pairs_from_documents(docs)) == {"doc_id", "text"}


def test_filters_reach_the_scan(spark, docs, tmp_path):
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,de)]" in plan(
        vocab.word_counts(docs.filter("lang = 'de'"))
    )
    root = write_splits(split.split_exact(docs, "doc_id"), str(tmp_path / "s"))
    assert re.search(r"PartitionFilters: \[[^\]]*split#\d+ IN \(val,validation\)", plan(read_split_dataset(spark, root, "val")))


def test_counts_are_combined_before_the_shuffle(docs):
    for frame in (
        vocab.word_counts(docs),
        summarize.document_frequencies(docs, "text"),
        validate.validate_pairs(docs, "lang", ["text"]),
    ):
        assert "partial_count" in plan(frame) or "partial_sum" in plan(frame)


def test_no_query_uses_a_cross_join(spark):
    from __spark_entry__ import queries

    for name in ("evaluation_report", "tfidf_extract", "collate_batches", "split_stratified", "sync_plan"):
        assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan(queries()[name](spark, SF_DIR))), name
