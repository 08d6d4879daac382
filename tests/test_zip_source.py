"""ZIP archives read by seeking, against the archives' own rows."""

from __future__ import annotations

import csv
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from briefloom.sinks.zip import write_zip_csv
from briefloom.sources import zip_source
from briefloom.sources.zip_source import open_file, scan_archives, scan_zip_files

SCHEMA = "id long, text string"


def archive(path, members, **options):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED, **options) as out:
        for name, text in members:
            out.writestr(name, text)


def as_csv(rows, header=("id", "text")):
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator="\n").writerows([header, *rows])
    return out.getvalue()


def test_one_partition_an_archive_and_the_first_csv_of_each(spark, tmp_path):
    rows = [(i, f'text "{i}",\nü') for i in range(7000)]
    for k in range(7):
        archive(tmp_path / f"a {k}.zip", [("note.txt", "x"), ("b.csv", as_csv(rows[k::7])), ("c.csv", "id\n1\n")])
    (tmp_path / "other.txt").write_text("no archive")
    frame = scan_zip_files(spark, str(tmp_path), SCHEMA, keep_path=True)
    assert frame.rdd.getNumPartitions() == 7
    assert sorted((r["id"], r["text"]) for r in frame.collect()) == rows
    assert frame.select(F.substring_index("path", "/", -1)).distinct().count() == 7


def test_only_the_member_is_read(tmp_path):
    """A large member beside the CSV is skipped by seeking."""
    archive(tmp_path / "a.zip", [("big.bin", "0123456789" * 10)], compresslevel=0)
    with zipfile.ZipFile(tmp_path / "b.zip", "w", zipfile.ZIP_STORED) as out:
        out.writestr("big.bin", bytes(30 << 20))
        out.writestr("x.csv", as_csv([(1, "a")]))
    reads = []

    class Counting:
        def __init__(self, file):
            self.file = file

        def __getattr__(self, name):
            return getattr(self.file, name)

        def read(self, n=-1):
            got = self.file.read(n)
            reads.append(len(got))
            return got

    with open_file(f"file:{tmp_path}/b.zip") as file, zipfile.ZipFile(Counting(file)) as held:
        assert held.read(zip_source.first_csv(held, "b")) == as_csv([(1, "a")]).encode()
    assert sum(reads) < 200_000


def test_an_archive_beyond_the_limit_of_a_binary_value(spark, tmp_path, monkeypatch):
    """What Spark cannot hold as one value is no error: nothing is read whole."""
    monkeypatch.setattr("briefloom.sources.archives.MAX_ARCHIVE", 10)
    archive(tmp_path / "a.zip", [("x.csv", as_csv([(1, "a"), (2, "NA")]))])
    assert sorted(map(tuple, scan_zip_files(spark, str(tmp_path), SCHEMA).collect()), key=str) == [(1, "a"), (2, None)]


def test_faults_and_no_archives(spark, tmp_path):
    assert scan_archives(spark, [], SCHEMA).collect() == [] and scan_archives(spark, [], SCHEMA).columns == ["id", "text"]
    archive(tmp_path / "none.zip", [("x.txt", "")])
    archive(tmp_path / "less.zip", [("x.csv", "id\n1\n")])
    archive(tmp_path / "cells.zip", [("x.csv", "id,text\n1\n")])
    for name, words in (("none", "No CSV file"), ("less", "missing in the header"), ("cells", "cells instead of")):
        with pytest.raises(Exception, match=words):
            scan_zip_files(spark, str(tmp_path / f"{name}.zip"), SCHEMA).collect()


def test_written_archives_come_back(spark, tmp_path):
    rows = spark.range(500).select("id", F.concat(F.lit('a "b"\n'), F.col("id").cast("string")).alias("text")).repartition(3)
    names = write_zip_csv(rows, f"file:{tmp_path}/out", "id").collect()
    assert sum(r["rows"] for r in names) == 500 and len(list((tmp_path / "out").glob("*.zip"))) == len(names)
    assert not [p for p in (tmp_path / "out").iterdir() if p.name.startswith(".")]
    back = scan_zip_files(spark, f"{tmp_path}/out", SCHEMA)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
