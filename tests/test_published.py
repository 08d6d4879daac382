"""Commits of several targets, counts kept between increments, and streams to several targets."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from briefloom.operators import increments, vocab
from briefloom.sinks.commits import committed, publish, read_published
from briefloom.sinks.tables import Target
from briefloom.sources import incremental
from briefloom.streaming import targets as streams

SCHEMA = "id long, part string, text string"


def rows_of(df):
    return sorted(map(tuple, df.select("id", "part", "text").collect()))


@pytest.fixture
def places(tmp_path):
    return [
        Target("parquet", str(tmp_path / "parquet"), "parquet", ("part",)),
        Target("csv", str(tmp_path / "csv"), "csv"),
        Target("off", str(tmp_path / "off"), enabled=False),
    ]


def test_a_failure_between_targets_shows_neither(spark, tmp_path, places):
    log = str(tmp_path / "log")
    first, second = ([(i, "ab"[i % 2], f'text "{i}"\nline') for i in range(n)] for n in (3, 7))
    broken = [places[0], Target("csv", places[1].path, "no such format")]
    with pytest.raises(Exception):
        publish(spark, log, "v1", [(spark.createDataFrame(second, SCHEMA), broken)])
    assert (tmp_path / "parquet" / "version=v1").exists() and committed(spark, log).count() == 0
    with pytest.raises(ValueError, match="nothing has been published"):
        read_published(spark, log, "parquet")
    paths = publish(spark, log, "v1", [(spark.createDataFrame(first, SCHEMA), places)])  # the rerun replaces what lies there
    assert paths["off"] is None and paths["csv"].endswith("csv/version=v1")
    with pytest.raises(Exception):
        publish(spark, log, "v2", [(spark.createDataFrame(second, SCHEMA), broken)])
    for name in ("parquet", "csv"):
        assert rows_of(read_published(spark, log, name)) == first
    publish(spark, log, "v2", [(spark.createDataFrame(second, SCHEMA), places)])
    assert publish(spark, log, "v1", [(spark.createDataFrame(second, SCHEMA), places)]) == paths  # committed: left alone
    for name in ("parquet", "csv"):
        assert rows_of(read_published(spark, log, name)) == second
        assert rows_of(read_published(spark, log, name, since=1)) == sorted(first + second)


def test_versions_and_names_are_checked(spark, tmp_path, places):
    df = spark.createDataFrame([], SCHEMA)
    for version in ("2024", "a/b", ""):
        with pytest.raises(ValueError, match="version"):
            publish(spark, str(tmp_path / "log"), version, [(df, places)])
    with pytest.raises(ValueError, match="repeat"):
        publish(spark, str(tmp_path / "log"), "v1", [(df, places), (df, places)])
    publish(spark, str(tmp_path / "log"), "v1", [(df, places)])
    assert read_published(spark, str(tmp_path / "log"), "csv").count() == 0


def test_increments_equal_one_count(spark, tmp_path):
    landing, store = tmp_path / "landing", str(tmp_path / "store")
    texts = ["the cat sat", "The cat, the dog", None, "", "a dog a day", "cat cat cat"]

    def land(i):
        spark.createDataFrame([(texts[i],), (f"word{i} the",)], "text string").coalesce(1).write.parquet(str(landing / f"f{i}"))

    def listing():
        return incremental.list_files(spark, str(landing), "*.parquet")

    def read(files):
        return incremental.read_files(spark, files, spark.createDataFrame([], "text string").schema)

    def failing(files):
        return read(files).withColumn("text", F.raise_error(F.lit("broken")).cast("string"))

    for i in range(len(texts)):
        land(i)
        if i == 2:
            with pytest.raises(Exception, match="broken"):
                increments.add_counts(spark, store, listing(), failing)
        assert increments.add_counts(spark, store, listing(), read, merge_after=2) == 1
        assert increments.add_counts(spark, store, listing(), read, merge_after=2) == 0
        whole = spark.read.parquet(*[str(landing / f"f{k}") for k in range(i + 1)])
        want = sorted(map(tuple, increments.word_and_document_counts(whole).collect()))
        assert sorted(map(tuple, increments.stored_counts(spark, store).select("word", "count", "docs").collect())) == want
        assert increments.stored_rows(spark, store) == 2 * (i + 1)
        assert increments.known_files(spark, store).count() == i + 1
    counts = {word: (n, docs) for word, n, docs in want}
    assert counts["cat"] == (5, 3) and counts["the"] == (9, 8) and counts["a"] == (2, 1)
    got = vocab.vocab_of_counts(increments.stored_counts(spark, store)).select("word", "count", "id").collect()
    assert got == vocab.build_vocab(whole).collect()
    merged = committed(spark, str(tmp_path / "store" / "log")).filter(F.col("version").startswith("merged-"))
    assert merged.select("version").distinct().count() == 2
    larger = listing().withColumn("length", F.col("length") + 1)
    with pytest.raises(ValueError, match="have changed"):
        increments.add_counts(spark, store, larger, read)


FILES = {
    "good one.csv": 'id,dialogue,summary\n1,"two\nlines","a ""quoted"" word"\n2,NA,x\n',
    "order.csv": "summary,extra,id,dialogue\ns3,e,3,d3\n",
    "cells.csv": "id,dialogue,summary\n4,too few\n5,d5,s5\n6,too,many,cells\n",
    "lacks.csv": "id,text\n7,d7\n",
    "empty.csv": "",
    "header.csv": "id,dialogue,summary\n",
    "notes.txt": "no table",
}


def test_stream_to_several_targets(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    outputs = streams.Outputs(
        [Target("parquet", str(tmp_path / "p")), Target("csv", str(tmp_path / "c"), "csv")],
        Target("quarantine", str(tmp_path / "q")), str(tmp_path / "log"),
    )

    def run():
        streams.start_targets(spark, str(landing), outputs, str(tmp_path / "state"), max_files=2).awaitTermination()
        return {
            name: sorted((tuple(r) for r in streams.read_target(spark, outputs, name).drop("version").collect()), key=repr)
            for name in ("parquet", "csv", "quarantine")
        }

    for name, text in FILES.items():
        (landing / name).write_text(text)
    got = run()
    good = [("1", "two\nlines", 'a "quoted" word'), ("2", None, "x"), ("3", "d3", "s3"), ("5", "d5", "s5")]
    assert got["parquet"] == got["csv"] == sorted(good, key=repr)
    bad = sorted((path.rsplit("/", 1)[1], reason, record.strip()) for path, reason, record in got["quarantine"])
    assert bad == [("cells.csv", "row", "4,too few"), ("cells.csv", "row", "6,too,many,cells"), ("lacks.csv", "header", "id,text")]
    assert run() == got
    # a batch that is handed over again after its commit adds nothing, whatever is in it
    again = spark.createDataFrame([(str(landing / "order.csv"),)], "path string")
    streams.publish_batch(again, 0, outputs, streams.CORPUS_SCHEMA)
    assert run() == got
    (landing / "later.csv").write_text("id,dialogue,summary\n9,d9,s9\n")
    assert run()["parquet"] == sorted([*good, ("9", "d9", "s9")], key=repr)
