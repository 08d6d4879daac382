from __future__ import annotations

import io
import json
import zipfile
from pathlib import Path

import numpy as np
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from briefloom.operators import validate
from briefloom.operators.encode import Limits, word_encoder
from briefloom.operators.vocab import build_vocab
from briefloom.plans import prepare, queries
from briefloom.sinks import manifest, npy, report, sync, tables
from briefloom.sources import archives, arrays, csv, incremental, npy_ranges, splits, uris
from briefloom.streaming import ingest

ROWS = [
    ("1", 'Ann: "Hi, you"\nBob: ok', "greeting"),
    ("2", "NA", "null"),
    ("3", "Grüße, naïve\r\nline", ""),
]
HEADER = '"id","dialogue","summary"\n'


def as_csv(rows):
    return HEADER + "".join(",".join('"' + c.replace('"', '""') + '"' for c in r) + "\n" for r in rows)


def write_zip(path, members):
    with zipfile.ZipFile(path, "w") as archive:
        for name, text in members:
            archive.writestr(name, text)


def test_zip_takes_the_first_csv(spark, tmp_path):
    write_zip(tmp_path / "a.zip", [("readme.txt", "x"), ("UPPER.CSV", "no"), ("one.csv", as_csv(ROWS)), ("two.csv", as_csv(ROWS[:1]))])
    write_zip(tmp_path / "b.zip", [("data/x.csv", as_csv([("4", "d", "s")]))])
    got = {r["id"]: (r["dialogue"], r["summary"]) for r in archives.read_zip_csv(spark, str(tmp_path)).collect()}
    assert got == {"1": (ROWS[0][1], "greeting"), "2": (None, None), "3": (ROWS[2][1], None), "4": ("d", "s")}
    assert archives.read_zip_csv(spark, str(tmp_path / "a.zip"), na_values=()).filter("id = '2'").first()["dialogue"] == "NA"


def test_zip_without_csv_is_an_error(spark, tmp_path):
    write_zip(tmp_path / "a.zip", [("readme.txt", "x")])
    with pytest.raises(Exception, match="No CSV file found in ZIP archive"):
        archives.read_zip_csv(spark, str(tmp_path)).collect()


def test_zip_casts_and_order_of_columns(spark, tmp_path):
    write_zip(tmp_path / "a.zip", [("x.csv", "id,more,n\n1,x,5\n2,y,\n")])
    schema = T.StructType.fromDDL("n int, id bigint")
    assert sorted(map(tuple, archives.read_zip_csv(spark, str(tmp_path), schema).collect()), key=str) == [(5, 1), (None, 2)]


def test_zip_cells_of_any_length(spark, tmp_path):
    """The csv module's own limit of 128 kB a cell does not hold, and long cells go on in small chunks."""
    rows = [(1, "word, " * 30_000), (2, 'a "b"\nc'), (None, "x" * (17 << 20)), (4, "d")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.zip_ingest(spark, str(tmp_path)).select("doc_id", F.md5("text"))
    assert sorted(map(str, got.collect())) == sorted(map(str, frame.select("doc_id", F.md5("text")).collect()))
    chunks = archives._member_rows(io.BytesIO(as_csv([("1", "x" * (17 << 20), ""), ("2", "b", "c")]).encode()), ["id"], set(), "a")
    assert list(chunks) == [[["1"]], [["2"]]]


def test_csv_read(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes(as_csv(ROWS).encode())
    got = {r["id"]: (r["dialogue"], r["summary"]) for r in csv.read_csv(spark, str(tmp_path / "x.csv")).collect()}
    assert got["1"] == (ROWS[0][1], "greeting") and got["2"] == (None, None) and got["3"][1] is None
    inferred = csv.read_csv(spark, [str(tmp_path / "x.csv")], None)
    assert dict(inferred.dtypes)["id"] == "int"
    with pytest.raises(AnalysisException):
        csv.read_csv(spark, str(tmp_path / "missing.csv"))


def test_csv_sink_round_trip_to_two_places(spark, tmp_path):
    rows = spark.createDataFrame(ROWS, csv.CORPUS_SCHEMA).withColumn("ids", F.array(F.lit(1), F.lit(2)))
    paths = [str(tmp_path / "a" / "b"), str(tmp_path / "c")]
    for _ in range(2):
        assert tables.write_csv(rows, *paths) == paths
    for path in paths:
        schema = T.StructType([*csv.CORPUS_SCHEMA, T.StructField("ids", T.StringType())])
        back = csv.read_csv(spark, path, schema, na_values=())
        got = {r["id"]: r for r in back.collect()}
        assert got["1"]["dialogue"] == ROWS[0][1] and got["2"]["dialogue"] == "NA" and got["1"]["ids"] == "[1,2]"


def test_targets_switched_off(spark, tmp_path):
    rows = spark.range(5)
    written = tables.write_targets(rows, [tables.Target("a", str(tmp_path / "a")), tables.Target("b", str(tmp_path / "b"), "csv", enabled=False)])
    assert written == {"a": str(tmp_path / "a"), "b": None} and not (tmp_path / "b").exists()
    assert tables.write_targets(rows, [tables.Target("b", "x", enabled=False)]) == {"b": None}


def test_splits_are_directories(spark, tmp_path):
    rows = spark.createDataFrame([(1, "train"), (2, "val"), (3, "test")], "id int, split string")
    root = tables.write_splits(rows, str(tmp_path / "s"))
    one = splits.read_split_dataset(spark, root, "validation")
    assert [r["id"] for r in one.collect()] == [2]
    assert len(one.inputFiles()) == 3 and "PartitionFilters: [split" in one._jdf.queryExecution().toString()
    assert splits.read_split_dataset(spark, root).count() == 3
    with pytest.raises(ValueError):
        splits.read_split_dataset(spark, root, "dev")


def test_npy(spark, tmp_path):
    np.save(tmp_path / "a.npy", np.arange(6, dtype="float32").reshape(3, 2))
    np.save(tmp_path / "b.npy", np.arange(4))
    got = arrays.read_npy(spark, str(tmp_path)).orderBy("path", "row").collect()
    assert [r["vector"] for r in got] == [[0, 1], [2, 3], [4, 5], [0], [1], [2], [3]]
    np.save(tmp_path / "c.npy", np.array([{"a": 1}], dtype=object), allow_pickle=True)
    with pytest.raises(Exception, match="allow_pickle"):
        arrays.read_npy(spark, str(tmp_path)).collect()


def test_npy_by_ranges(spark, tmp_path):
    """Every shape and order that ``numpy.save`` writes, in ranges of a few rows, equals reading it whole."""
    rng = np.random.default_rng(4)
    made = {
        "rows.npy": rng.normal(size=(1_001, 7)).astype("float32"), "columns.npy": np.asfortranarray(rng.normal(size=(57, 5))),
        "line.npy": np.arange(9), "deep.npy": rng.integers(0, 9, (4, 3, 2)).astype("int16"), "one.npy": np.array(2.5),
        "none.npy": np.zeros((0, 3)), "big.npy": rng.normal(size=(20, 3)).astype(">f8"), "flags.npy": np.array([[True], [False]]),
        "narrow.npy": np.zeros((3, 0)),
    }
    (tmp_path / "in" / "deeper").mkdir(parents=True)
    for i, (name, array) in enumerate(made.items()):
        np.save(tmp_path / "in" / ("deeper" if i % 2 else ".") / name, array)
    out = npy_ranges.read_npy_ranges(spark, str(tmp_path / "in"), range_bytes=300)
    got = {(r["path"].rsplit("/", 1)[-1], r["row"]): r["vector"] for r in out.collect()}
    want = {}
    for name, array in made.items():
        array = np.atleast_1d(array)
        width = int(np.prod(array.shape[1:]))
        want |= {(name, i): row.tolist() for i, row in enumerate(array.reshape(len(array), width).astype("float64"))}
    assert got == want
    tasks = out.filter("path like '%rows.npy'").select(F.spark_partition_id()).distinct().count()
    assert tasks > 1


@pytest.mark.parametrize("content, message", [
    (b"PK", "not an array file"), (npy_ranges.header_bytes("<f4", (3, 2)) + bytes(20), "does not fit"),
    (npy_ranges.header_bytes("|O", (1,)) + bytes(8), "not an array of numbers"),
])
def test_bad_npy(spark, tmp_path, content, message):
    (tmp_path / "a.npy").write_bytes(content)
    with pytest.raises(Exception, match=message):
        npy_ranges.read_npy_ranges(spark, str(tmp_path)).collect()


def test_written_npy(spark, tmp_path):
    rows = [(i, [float(i), i / 2]) for i in range(50)]
    df = spark.createDataFrame(rows, "k long, v array<float>").repartition(4)
    owners = npy.write_npy(df, str(tmp_path / "out"), "v", "k").collect()
    assert {r["key"] for r in owners} == set(range(50))
    held = {f.name: np.load(f) for f in (tmp_path / "out").glob("*.npy")}
    assert all(held[r["name"]][r["row"]].tolist() == dict(rows)[r["key"]] for r in owners)
    for bad in ([(1, [1.0]), (2, [1.0, 2.0])], [(1, None)], [(None, [1.0])], [(1, [None])]):
        with pytest.raises(Exception, match="vectors of one length"):
            npy.write_npy(spark.createDataFrame(bad, "k long, v array<float>").coalesce(1), str(tmp_path / "bad"), "v", "k").collect()


def test_sync_by_content(spark, tmp_path):
    """Renamed and same-size changed files, files of several pieces, and copies, from what the files hold."""
    here = {"same": b"a" * 25, "changed": b"b" * 25, "new name": b"c" * 31, "new": b"d" * 31, "twin": b"c" * 31, "longer": b"e" * 9}
    there = {"same": b"a" * 25, "changed": b"x" + b"b" * 24, "old name": b"c" * 31, "older name": b"c" * 31, "gone": b"f" * 25, "longer": b"e" * 8}
    listings = []
    for side, made in (("here", here), ("there", there)):
        (tmp_path / side).mkdir()
        for name, content in made.items():
            (tmp_path / side / name).write_bytes(content)
        listings.append(incremental.list_files(spark, str(tmp_path / side)))
    plan = {r["rel_path"]: (r["key"], r["action"], r["origin"]) for r in sync.sync_by_content(*listings, "p", piece_bytes=10).collect()}
    assert plan == {
        "same": ("p/same", "same", None), "changed": ("p/changed", "replace", None), "new name": ("p/new name", "duplicate", "p/old name"),
        "twin": ("p/twin", "duplicate", "p/old name"), "new": ("p/new", "copy", None),
        "longer": ("p/longer", "replace", None), "old name": ("p/old name", "extra", None), "older name": ("p/older name", "extra", None),
        "gone": ("p/gone", "extra", None),
    }
    whole = {r["path"]: r["digest"] for r in sync.digests(listings[0], 10).collect()}
    assert len(set(whole.values())) == 5
    # pieces in another order are another file
    (tmp_path / "order").mkdir()
    for name, content in (("a", b"0123456789abcdefghij"), ("b", b"abcdefghij0123456789")):
        (tmp_path / "order" / name).write_bytes(content)
    assert sync.digests(incremental.list_files(spark, str(tmp_path / "order")), 10).select("digest").distinct().count() == 2
    nothing = listings[1].limit(0)
    assert {r["action"] for r in sync.sync_by_content(listings[0], nothing).collect()} == {"copy"}
    assert {r["action"] for r in sync.sync_by_content(nothing, listings[1]).collect()} == {"extra"}


URIS = [
    ("s3://b/k", ("b", "k", True)), ("s3://b/k/x\ny", ("b", "k/x\ny", True)), ("s3://b/", ("b", "", True)),
    ("s3:///k", ("", "k", True)), ("s3://b", (None, None, False)), ("http://b/k", (None, None, False)), (None, (None, None, False)),
]


def test_uris(spark):
    rows = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(URIS)], "i int, u string")
    got = rows.orderBy("i").select(uris.parse_uri(F.col("u")).alias("p")).collect()
    assert [tuple(r["p"]) for r in got] == [want for _, want in URIS]
    with pytest.raises(Exception, match="Invalid object URI"):
        rows.select(uris.parse_uri(F.col("u"), strict=True)).collect()


def test_download_urls(spark):
    urls = [("https://github.com/a/blob/b/blob/c.zip",), ("https://github.com/a/raw/c",), ("https://x.org/blob/c",), ("https://github.com/a/raw/b/raw/c.zip",)]
    got = {r["url"]: r["n_sources"] for r in uris.source_manifest(spark.createDataFrame(urls, "url string")).collect()}
    assert got == {"https://github.com/a/raw/b/raw/c.zip": 2, "https://github.com/a/raw/c": 1, "https://x.org/blob/c": 1}


def test_listing_and_new_files(spark, tmp_path):
    for name in ("a.csv", "d/b.csv", "d/e/c.csv"):
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(name)
    listed = incremental.list_files(spark, str(tmp_path / "in"))
    assert {(r["rel_path"], r["length"]) for r in listed.collect()} == {("a.csv", 5), ("d/b.csv", 7), ("d/e/c.csv", 9)}
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]
    fresh = incremental.new_files(listed, listed.filter("rel_path <> 'd/b.csv'"))
    assert [r["rel_path"] for r in fresh.collect()] == ["d/b.csv"]
    text = T.StructType.fromDDL("value string")
    assert [r["value"] for r in incremental.read_files(spark, fresh, text, "text").collect()] == ["d/b.csv"]
    assert incremental.read_files(spark, fresh.limit(0), text, "text").count() == 0
    with pytest.raises(ValueError, match="several steps"):
        incremental.read_files(spark, listed, text, "text", max_files=2)
    late, early = "timestamp'2999-01-01'", "timestamp'1999-01-01'"
    there = spark.sql(f"VALUES ('a.csv', 5L, {late}), ('d/b.csv', 6L, {late}), ('old', 1L, {late}) AS t(rel_path, length, modified)")
    plan = {r["rel_path"]: (r["key"], r["action"]) for r in sync.sync_plan(listed, there, "/p/").collect()}
    assert plan == {"a.csv": ("p/a.csv", "replace"), "d/b.csv": ("p/d/b.csv", "replace"), "d/e/c.csv": ("p/d/e/c.csv", "copy"), "old": ("p/old", "extra")}
    assert [r["key"] for r in sync.sync_plan(listed, there, only_changed=True).filter("action = 'same'").collect()] == ["a.csv"]
    older = there.withColumn("modified", F.expr(early))
    assert sync.sync_plan(listed, older, only_changed=True).filter("action = 'same'").count() == 0


def test_reports(spark, tmp_path):
    rows = spark.createDataFrame([("m", "rouge1", 0.25), ("m", "bleu", None), ("n", "rouge1", 1.0)], "model string, metric string, value double")
    text = spark.read.text(report.write_report(rows, str(tmp_path / "y"), "yaml"))
    assert {r["value"] for r in text.collect()} == {"m:", "  bleu: null", "  rouge1: 0.25", "n:", "  rouge1: 1.0"}
    odd = rows.withColumn("model", F.lit('a: "b"'))
    text = spark.read.text(report.write_report(odd, str(tmp_path / "q"), "yaml"))
    assert '"a: \\"b\\"":' in {r["value"] for r in text.collect()}
    nested = spark.read.text(report.write_report(rows, str(tmp_path / "n"), "nested"))
    assert json.loads(nested.orderBy("value").first()["value"]) == {"model": "m", "metrics": {"bleu": None, "rouge1": 0.25}}
    assert spark.read.json(report.write_report(rows, str(tmp_path / "j"))).count() == 3
    with pytest.raises(ValueError):
        report.write_report(rows, str(tmp_path / "z"), "xml")


def test_validation_report(spark):
    rows = spark.createDataFrame([("1", "a", "b"), ("1", "a", "b"), ("1", None, "b"), (None, "a", " "), (None, "", None)], csv.CORPUS_SCHEMA)
    got = validate.validate_pairs(rows).first().asDict()
    assert got == {
        "n_rows": 5, "n_valid": 2, "null_dialogue": 1, "blank_dialogue": 1, "null_summary": 1, "blank_summary": 1,
        "n_ids": 1, "n_duplicate_rows": 2,
    }
    assert validate.valid_pairs(rows).count() == 2
    assert validate.validate_pairs(rows.limit(0)).first()["n_rows"] == 0


def test_stream_takes_each_file_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    args = (str(landing), str(tmp_path / "out"), str(tmp_path / "state"))
    (landing / "1.csv").write_text(as_csv(ROWS))
    assert ingest.stream_ingest(spark, *args).count() == 3
    assert ingest.stream_ingest(spark, *args).count() == 3
    (landing / "2.csv").write_text(as_csv([("9", "x", "y")]))
    out = ingest.stream_ingest(spark, *args, max_files=1)
    assert out.count() == 4 and out.filter("id = '2' and dialogue is null").count() == 1


def test_whole_run(spark, tmp_path):
    rows = [(str(i), f"A: hello number {i}\nB: fine", f"greeting {i}") for i in range(40)] + [("x", "", "blank"), ("y", "NA", "gap")]
    (tmp_path / "in").mkdir()
    write_zip(tmp_path / "in" / "a.zip", [("c.csv", as_csv(rows[:20]))])
    write_zip(tmp_path / "in" / "b.zip", [("c.csv", as_csv(rows[20:]))])
    run = prepare.Run(str(tmp_path / "main"), str(tmp_path / "copy"), formats=("parquet", "csv"), backup_enabled=False)
    corpus = prepare.run_ingestion(spark, run, str(tmp_path / "in"))
    assert corpus.count() == 42
    valid = prepare.run_validation(spark, run, corpus)
    vocab = build_vocab(valid, "dialogue", 50)
    features = prepare.run_transformation(spark, run, valid, vocab, limits=Limits(16, 8))
    counts = {r["split"]: r["count"] for r in features.groupBy("split").count().collect()}
    assert counts == {"train": 32, "val": 4, "test": 4}
    assert features.filter((F.size("input_ids") != 16) | (F.size("labels") != 8)).count() == 0
    predictions = features.select("id", F.lit("copy").alias("model"), F.col("summary").alias("prediction"), F.col("summary").alias("reference"))
    scores = {r["metric"]: r["value"] for r in prepare.run_evaluation(spark, run, predictions).collect()}
    assert scores["rouge1"] == scores["rougeL"] == scores["rougeLsum"] == 1.0
    listed = spark.read.parquet(f"{run.primary}/manifest")
    assert listed.filter("target like 'backup%' and uri is not null").count() == 0
    assert listed.filter("target like 'primary%' and uri is null").count() == 0
    assert {r["stage"] for r in listed.collect()} == {"data_ingestion", "data_validation", "data_transformation", "model_evaluation"}
    assert not (tmp_path / "copy").exists()
    again = prepare.run_transformation(
        spark, prepare.Run(str(tmp_path / "off"), primary_enabled=False), valid, encode=word_encoder(vocab), limits=Limits(16, 8)
    )
    assert again.count() == 40 and not (tmp_path / "off").exists()
    stored = listed.filter("artifact = 'ingested_data' and target = 'primary:parquet'").first()
    assert stored["n_rows"] == 42 and stored["n_bytes"] > 0
    assert listed.filter("target = 'source'").count() == 2
    write_zip(tmp_path / "in" / "c.zip", [("c.csv", as_csv(rows[:3]))])
    assert prepare.run_ingestion(spark, prepare.Run(run.primary, stamp="later"), str(tmp_path / "in")).count() == 3
    assert prepare.run_ingestion(spark, prepare.Run(run.primary, stamp="last"), str(tmp_path / "in")).count() == 0


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("summary,dialogue,id\nS1,D1,1\n")
    (tmp_path / "b.csv").write_text('id,more,summary,dialogue\n2,x,S2,"D2\nnext"\n')
    got = sorted(map(tuple, csv.read_csv(spark, str(tmp_path / "*.csv")).collect()))
    assert got == [("1", "D1", "S1"), ("2", "D2\nnext", "S2")]
    for name, text in (("lacking", "id,summary\n1,S\n"), ("short", "id,dialogue,summary\n1,D\n"), ("long", "id,dialogue,summary\n1,D,S,x,y\n")):
        (tmp_path / f"{name}.txt").write_text(text)
        with pytest.raises(Exception, match="missing|MALFORMED|FAILED_READ_FILE|Malformed"):
            csv.read_csv(spark, str(tmp_path / f"{name}.txt")).collect()
    for name, text in (("l", "Id,text,sum\n1,D,S\n"), ("s", "id,dialogue,summary\n1,D\n")):
        write_zip(tmp_path / f"{name}.zip", [("c.csv", text)])
        with pytest.raises(Exception, match="missing in the header|cells instead of"):
            archives.read_zip_csv(spark, str(tmp_path / f"{name}.zip")).collect()


def test_split_aliases(spark, tmp_path):
    from briefloom.sources.splits import read_split_dataset

    spark.createDataFrame([(1, "train"), (2, "validation"), (3, "test")], "i int, split string").write.partitionBy("split").parquet(str(tmp_path / "t"))
    for name in ("val", "validation"):
        assert [tuple(r) for r in read_split_dataset(spark, str(tmp_path / "t"), name).collect()] == [(2, "val")]
    assert {r["split"] for r in read_split_dataset(spark, str(tmp_path / "t")).collect()} == {"train", "val", "test"}


def test_split_manifest_of_odd_rows(spark):
    from briefloom.operators.report import split_manifest

    rows = spark.createDataFrame([("a", None), ("b", "train"), ("b", "train")], "x string, split string")
    got = [tuple(r) for r in split_manifest(rows, ["x"]).collect()]
    assert sorted(r[1] for r in got if r[0] == "total") == [3] and {r[0] for r in got} == {None, "train", "total"}
    other = spark.createDataFrame([("c", "train"), ("c", "train")], "x string, split string")
    marks = {r["split"]: r["fingerprint"] for r in split_manifest(other, ["x"]).collect()}
    assert marks["train"] not in (0, next(r[3] for r in got if r[0] == "train"))


def test_stamp():
    from datetime import datetime

    assert manifest.run_stamp(datetime(2024, 1, 2, 3, 4, 5)) == "2024_01_02T03_04_05Z"
    assert manifest.run_path("b/", "s", "st", "n") == "b/artifacts/s/st/n"


def test_feature_streams_take_batches_of_bytes(spark, tmp_path, monkeypatch):
    for i in range(12):
        (tmp_path / f"f{i}.csv").write_text(as_csv([(str(i), "a b " * 50, "a")]), newline="")
    (tmp_path / "in").mkdir()
    for i in range(12):
        (tmp_path / f"f{i}.csv").rename(tmp_path / "in" / f"f{i}.csv")
    monkeypatch.setattr(ingest, "TASK_BYTES", 100)  # times the session's cores: a few files
    encoder = word_encoder(build_vocab(spark.createDataFrame([("a b",)], "text string"), size=10))
    out = ingest.stream_features(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), encoder)
    assert sorted(int(r["id"]) for r in out.select("id").collect()) == list(range(12))
    batches = [p for p in (tmp_path / "state" / "commits").iterdir() if p.name.isdigit()]
    assert len(batches) > 1


def test_files_of_csv_roundtrip_do_not_grow_with_the_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "CSV_FILE_BYTES", 100_000)
    landed = []
    monkeypatch.setattr(queries, "fresh_folder", lambda spark, name: landed.append(str(tmp_path / f"csv{len(landed)}")) or landed[-1])
    for n in (100, 600):  # few rows, each of 10,000 bytes
        rows = spark.range(n).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 2_000).alias("text"))
        rows.coalesce(1).write.parquet(str(tmp_path / str(n) / "documents.parquet"))
        back = queries.csv_roundtrip(spark, str(tmp_path / str(n)))
        assert back.agg(F.count("doc_id"), F.sum("n_words")).first() == (n, 2_001 * n)
    sizes = [max(p.stat().st_size for p in Path(folder).glob("*.csv")) for folder in landed]
    assert sizes[1] < 1.5 * sizes[0]
