"""The pipeline, stage by stage against brute force on a small made-up corpus."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_exact_operators import brute_components, brute_substrings, words

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") + rng.choice("bcdfglmnprst") + rng.choice("aeiou") + str(rng.choice("nrst")) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    base = [prose(rng, rng.randrange(40, 200)) for _ in range(30)]
    passage, items = prose(rng, 45), [prose(rng, 24) for _ in range(3)]
    texts = [*base, base[0], base[0] + " tail", base[1].replace(" ", "  "), *(prose(rng, 60) + "\n" + passage for _ in range(4))]
    texts += [prose(rng, 50) + " " + items[0] + " " + prose(rng, 30), items[1], "short", None, "", "junk### " * 40, "LOUD WORDS! " * 30]
    rows = [(i, t, "en", f"s{i % 4}", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[2], (None, prose(rng, 70), None, None, None)]
    out = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, DOCS).withColumn("sig", F.lit(1)).repartition(3).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return out


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [r["text"] for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    before = [tuple(r)[:5] for r in docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        rows = docs.collect()
        if name == "mixing":
            break
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        after = [tuple(r) for r in rows]
        if name == "quality_rules":
            assert sorted(after, key=repr) == sorted((r for r in before if len(words(r[1])) >= 20 and "###" not in r[1] and "LOUD" not in r[1]), key=repr)
        elif name == "near_duplicates":
            roots = {low for _, _, low in brute_components([r for r in before if r[0] is not None], 5, 80)} | {None}
            assert sorted([r[0] for r in after], key=repr) == sorted(roots, key=repr)
            assert set(after) <= set(before)
        elif name == "substring_dedup":
            want = {i: (kept, gone) for i, kept, _, gone in brute_substrings(before, 35)}
            texts = {r[0]: r[1] for r in before}
            assert {r[0]: r[1] for r in after} == {i: kept if gone else texts[i] for i, (kept, gone) in want.items() if kept}
            assert any(gone for _, gone in want.values())
        else:
            assert {r[0] for r in before} - {r[0] for r in after} == {r[0] for r in before if any(x in r[1] for x in items)} != set()
            assert set(after) <= set(before)
        before = after
    size = {}
    for r in before:
        size[r[3]] = size.get(r[3], 0) + len(words(r[1]))
    taken = {}
    for r in rows:
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        assert r["taken"] <= r["size"]
    assert sum(taken.values()) == pytest.approx(1.5 * sum(size.values()), abs=len(size) + 1)
    assert all(n <= 2 * size[s] for s, n in taken.items())
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect()), key=repr) == sorted(map(tuple, rows), key=repr)


def test_stages_of_nothing(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0
