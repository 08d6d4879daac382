from __future__ import annotations

import functools
import itertools
import math
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from briefloom import scaling
from briefloom.operators import batches, encode, pieces, vocab
from briefloom.operators.encode import Limits
from briefloom.plans import queries
from briefloom.scaling import heaviest, left_lookup

TEXTS = [
    ("a", "the cat and the dog", "the cat"),
    ("b", None, ""),
    ("c", "?!...", "zebra"),
    ("d", "cat " * 50, "dog dog dog"),
    ("e", "Été the naïve", "unseen words only"),
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(TEXTS, "id string, dialogue string, summary string")


@pytest.fixture(scope="module")
def words(spark, rows):
    return vocab.build_vocab(rows, "dialogue", 3).cache()


def test_vocab_order_ids_and_limit(words):
    # cat 51 times, the 3 times, then the tie of single words: alphabetical
    assert [(r["word"], r["count"], r["id"]) for r in words.orderBy("id").collect()] == [
        ("cat", 51, 106), ("the", 3, 107), ("and", 1, 108),
    ]


def test_features(rows, words):
    out = {r["id"]: r for r in encode.encode_pairs(rows, words, Limits(8, 4)).collect()}
    assert out["a"]["input_ids"] == [107, 106, 108, 107, 105, 1, 0, 0]
    assert out["a"]["attention_mask"] == [1, 1, 1, 1, 1, 1, 0, 0]
    assert out["a"]["labels"] == [107, 106, 1, 0]
    assert out["b"]["input_ids"] == [1] + [0] * 7 and out["b"]["labels"] == [1, 0, 0, 0]
    assert out["c"]["input_ids"] == [1] + [0] * 7 and out["c"]["labels"] == [105, 1, 0, 0]
    assert out["d"]["input_ids"] == [106] * 7 + [1] and out["d"]["labels"] == [105, 105, 105, 1]
    assert sum(out["d"]["attention_mask"]) == 8
    assert (out["a"]["dialogue"], out["a"]["summary"]) == TEXTS[0][1:]


def test_label_padding(rows, words):
    out = encode.encode_pairs(rows, words, Limits(8, 4, batches.IGNORED_LABEL)).filter("id = 'a'").first()
    assert out["labels"] == [107, 106, 1, -100] and out["input_ids"][-1] == 0


def test_join_path_gives_the_same_features(rows, words):
    want = sorted(map(str, encode.encode_pairs(rows, words, Limits(8, 4)).collect()))
    assert sorted(map(str, encode.encode_pairs(rows, words, Limits(8, 4), max_rows=1).collect())) == want


def test_join_path_does_not_use_ids(spark, words):
    rows = spark.createDataFrame([("1", "to be", "or"), ("1", "not", "be be be"), (None, "to", "x"), (None, "be", "")], "id string, dialogue string, summary string")
    want = sorted(map(str, encode.encode_pairs(rows, words, Limits(6, 4)).collect()))
    assert sorted(map(str, encode.encode_pairs(rows, words, Limits(6, 4), max_rows=1).collect())) == want


def test_a_block_asks_once_for_each_of_its_words(spark, words):
    texts = spark.range(300).coalesce(1).select(F.lit("the cat and the dog").alias("text"))
    rows = encode.numbered(texts)
    asked = encode.asked_words(rows, encode.kept_tokens(F.col("text"), 100))
    assert asked.count() == 2 * 4  # 300 rows are two blocks
    want = encode.word_encoder(words)(F.col("text"), 100)
    ids = encode.encode_by_join(rows, words, "text", 100, max_rows=1).select("ids", want.alias("want"))
    assert ids.count() == 300 and ids.filter("ids != want").count() == 0


def test_large_vocab_is_not_sent(words):
    assert encode.word_encoder(words, max_rows=2) is None


@pytest.mark.parametrize("limit", [1, 5, 1000])
def test_lookup_by_broadcast_and_by_join(spark, limit):
    table = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"), (100 - F.col("id")).alias("n"))
    rows = spark.range(3000).select(F.when(F.col("id") < 1500, 0).when(F.col("id") < 2000, 999).when(F.col("id") >= 2100, F.col("id") % 120).alias("k"), "id")
    got = left_lookup(rows, table.drop("n"), "k", max_rows=limit, hot_rows=3)
    assert got.count() == 3000
    wrong = got.filter(~F.col("v").eqNullSafe(F.when(F.col("k") < 100, F.col("k") * 2)))
    assert wrong.count() == 0


@pytest.mark.parametrize("size", [1, 7, 40, 500])
def test_heaviest_by_plain_top_k_and_by_weight_level(spark, size):
    table = spark.range(200).select(F.col("id").alias("name"), F.floor(F.sqrt("id")).alias("w")).repartition(6)
    plain, levelled = (heaviest(table, size, "w", "name", limit) for limit in (1000, 10))
    want = sorted(((int(math.sqrt(i)), -i) for i in range(200)), reverse=True)[:size]
    for got in (plain, levelled):
        assert sorted(((r["w"], -r["name"]) for r in got.collect()), reverse=True) == want


def test_length_profile(spark):
    rows = spark.range(10).select(F.lit("train").alias("split"), F.repeat(F.lit("w "), (F.col("id") + 1).cast("int")).alias("t"))
    got = encode.length_profile(rows, "t", 8).first()
    assert (got["n_rows"], got["n_cut"], got["max_tokens"]) == (10, 3, 10)
    assert (got["p50"], got["p95"]) == (5.5, pytest.approx(9.55))


def segmentations(word, scores, unknown):
    """Every way to cut a word into known pieces and unknown characters."""
    for cuts in itertools.product((0, 1), repeat=max(len(word) - 1, 0)):
        parts, start = [], 0
        for i, cut in enumerate(cuts, 1):
            if cut:
                parts.append(word[start:i])
                start = i
        parts.append(word[start:])
        if all(p in scores or len(p) == 1 for p in parts):
            yield sum(scores.get(p, unknown) for p in parts), parts


def test_best_segmentation_against_all_cuts():
    rng = random.Random(1)
    for _ in range(200):
        scores = {"".join(rng.choices("abc", k=rng.randint(1, 4))): -rng.random() * 8 for _ in range(12)}
        word = "".join(rng.choices("abcd", k=rng.randint(1, 9)))
        got = pieces.best_segmentation(word, scores, 4, -20.0)
        value = sum(-20.0 if p is None else scores[p] for p in got)
        assert value == pytest.approx(max(s for s, _ in segmentations(word, scores, -20.0)))
        assert sum(1 if p is None else len(p) for p in got) == len(word)


def test_piece_encoder(spark, rows):
    table = spark.createDataFrame(
        [("the", -1.0, 200), ("c", -3.0, 201), ("at", -2.0, 202), ("dog", -2.5, 203), ("d", -3.0, 204)],
        "piece string, logp double, id int",
    )
    out = {r["id"]: r for r in encode.encode_features(rows, pieces.piece_encoder(table), Limits(8, 4)).collect()}
    # "and" -> a (unknown), n (unknown), d
    assert out["a"]["input_ids"] == [200, 201, 202, 105, 105, 204, 200, 1]
    assert out["a"]["labels"] == [200, 201, 202, 1]
    assert out["b"]["input_ids"] == [1] + [0] * 7
    assert out["d"]["input_ids"] == [201, 202] * 3 + [201, 1]


def test_piece_encoder_with_word_marks_and_case(spark):
    table = spark.createDataFrame([("▁Hi", -1.0, 300), ("▁", -2.0, 301), ("hi!", -1.0, 302)], "piece string, logp double, id int")
    encoder = pieces.piece_encoder(table, word_mark="▁", cased=True)
    rows = spark.createDataFrame([("Hi hi!",)], "t string")
    assert rows.select(encoder(F.col("t"), 10).alias("i")).first()["i"] == [300, 301, 302]


def test_pieces_match_sentencepiece_segmentation(spark, tmp_path):
    """The published library, given the same corpus, cuts words as its own scores say."""
    spm = pytest.importorskip("sentencepiece")
    corpus = tmp_path / "corpus.txt"
    rng = random.Random(4)
    syllables = ["ka", "to", "mi", "re", "sun", "the", "ing", "ed"]
    lines = [" ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(12)) for _ in range(400)]
    corpus.write_text("\n".join(lines))
    prefix = str(tmp_path / "m")
    spm.SentencePieceTrainer.train(
        input=str(corpus), model_prefix=prefix, vocab_size=120, model_type="unigram", hard_vocab_limit=False, minloglevel=2
    )
    model = spm.SentencePieceProcessor(model_file=f"{prefix}.model")
    scores = {model.id_to_piece(i): model.get_score(i) for i in range(3, model.get_piece_size())}
    longest = max(map(len, scores))
    total = lambda parts: sum(scores[p] for p in parts)
    for word in {w for line in lines[:60] for w in line.split()}:
        ours = pieces.best_segmentation("▁" + word, scores, longest, -99.0)
        theirs = model.encode(word, out_type=str)
        assert total(ours) == pytest.approx(total(theirs), abs=1e-4)


def test_build_pieces(spark):
    rows = spark.createDataFrame([("abab ab",), ("b",)], "text string")
    got = {r["piece"]: r for r in vocab.build_pieces(rows, size=2, longest=2).collect()}
    # b: 2 + 1 + 1, a: 2 + 1, ab: 2 + 1, ba: 1
    assert {p: r["count"] for p, r in got.items()} == {"b": 4, "a": 3}
    assert got["b"]["id"] == 106 and got["b"]["logp"] == round(math.log(4 / 7), 6)


def test_collate(spark):
    rows = spark.createDataFrame(
        [("a", "train", [7, 1], [9, 8, 1]), ("b", "train", [7, 6, 5, 1], [1]), ("c", "train", [1], [2, 1]), ("d", "val", [3, 1], [4, 1])],
        "id string, split string, ids array<int>, label_ids array<int>",
    )
    out = batches.collate_batches(rows).collect()
    assert sorted((r["split"], r["batch"], len(r["ids"])) for r in out) == [("train", 0, 2), ("train", 1, 1), ("val", 0, 1)]
    source = {r["id"]: r for r in rows.collect()}
    for r in out:
        width = max(len(source[i]["ids"]) for i in r["ids"])
        for i, ids, mask, labels in zip(r["ids"], r["input_ids"], r["attention_mask"], r["labels"]):
            n = len(source[i]["ids"])
            assert ids == source[i]["ids"] + [0] * (width - n)
            assert mask == [1] * n + [0] * (width - n)
            m = len(source[i]["label_ids"])
            assert labels[:m] == source[i]["label_ids"] and set(labels[m:]) <= {-100}


def test_map_batched_overrides_and_keeps(spark):
    rows = spark.range(25).select("id", F.lit("x").alias("text"))
    out = batches.map_batched(rows, lambda b: {"text": [t * 2 for t in b["text"]], "n": [len(b["id"])] * len(b["id"])}, "text string, n int")
    got = out.collect()
    assert out.columns == ["id", "text", "n"] and len(got) == 25
    assert {r["text"] for r in got} == {"xx"}


def test_batch_infer_loads_once_per_task(spark):
    def factory():
        state = {"loads": 1}
        return lambda texts: [f"{t}:{state['loads']}" for t in texts]

    rows = spark.createDataFrame([("a", "t")], "id string, dialogue string")
    assert batches.batch_infer(rows, factory).first()["prediction"] == "t:1"


def test_batches_do_not_depend_on_partitions(spark, monkeypatch):
    """Repeated ids, short stretches, and every partitioning give the same batches."""
    rows = spark.range(200).select(
        (F.col("id") % 60).cast("string").alias("id"), F.when(F.col("id") % 5 == 0, "val").otherwise("train").alias("split"),
        F.array(F.col("id").cast("int")).alias("ids"), F.array_repeat(F.col("id").cast("int"), 2).alias("label_ids"),
    )
    want = sorted(map(str, batches.collate_batches(rows.repartition(1), rows_per_batch=3).collect()))
    monkeypatch.setattr(batches, "STRETCH_ROWS", 10)
    for parts in (1, 7):
        assert sorted(map(str, batches.collate_batches(rows.repartition(parts), rows_per_batch=3).collect())) == want
    assert len(want) == 14 + 54


def test_batches_move_the_arrays_once(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("split"), F.array("n_chars").cast("array<int>").alias("ids"), F.array("n_chars").cast("array<int>").alias("label_ids"),
    )
    plan = batches.collate_batches(rows)._jdf.queryExecution().executedPlan().toString()
    wide = [line.strip(" :+-*") for line in plan.splitlines() if "Exchange hashpartitioning(split" in line and "_stretch" in line]
    # written twice in the plan before it runs, and run once: the second is the same exchange
    assert len({line.split("#")[0] for line in wide}) == 1


def test_batches_of_ids_do_not_follow_the_row_groups_of_a_file(spark, tmp_path, monkeypatch):
    words = F.array_join(F.transform(F.sequence(F.lit(0), F.col("id") % 7), lambda k: F.concat(F.lit("w"), k * 3 % 5)), ". ")
    rows = spark.range(600).select(F.col("id").alias("doc_id"), words.alias("text"), F.sha2(F.col("id").cast("string"), 512).alias("source"))
    rows.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    want = sorted(map(str, queries.collate_batches(spark, str(tmp_path)).collect()))
    session = spark.newSession()  # one row group, far more byte ranges than it asks for
    session.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    session.conf.set("spark.sql.files.openCostInBytes", "100")
    monkeypatch.setattr(queries, "spread", functools.partial(scaling.spread, small=10, task_rows=50))
    pieces = queries.documents(session, str(tmp_path)).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(pieces) > 10 and max(r["count"] for r in pieces) <= 60
    assert sorted(map(str, queries.collate_batches(session, str(tmp_path)).collect())) == want


@pytest.mark.parametrize("unicode", [False, True])
def test_texts_reach_the_encoder_and_long_ones_only_with_the_tokens_that_fit(spark, words, unicode):
    cases = [*(t for _, *both in TEXTS for t in both), "The K K CAT dog", "cat-dog\n\tcat İ", "x " * 300 + "cat", "é dog " * 40, "cat" * 500]
    rows = spark.createDataFrame([(t,) for t in cases], "text string").coalesce(1)
    table = {r["word"]: r["id"] for r in words.collect()}
    encoder = encode.word_encoder(words, unicode)
    for most in (1, 2, 7, 100):
        got = rows.select("text", encode.kept_tokens(F.col("text"), most, unicode).alias("tokens"), encoder(F.col("text"), most).alias("ids"))
        for r in got.collect():
            assert r["ids"] == [table.get(t, vocab.UNKNOWN_ID) for t in r["tokens"]]
    sent = rows.select(encode.kept_text(F.col("text"), 7, unicode).alias("t"), F.octet_length(F.col("text")).alias("n"))
    assert all(len(r["t"].split()) <= 6 for r in sent.filter(f"n > {7 * encode.WHOLE_BYTES}").collect())


def test_token_strings_are_held_for_a_step_of_texts(monkeypatch):
    """The most bytes that Arrow holds do not grow with the tokens of the batch."""
    text = " ".join(f"w{k % 50}" for k in range(1000))
    ids = {f"w{k}": k for k in range(40)}
    texts = pa.array([text] * 2000)
    before, pool = pa.total_allocated_bytes(), []
    cut = encode.words

    def watched(part):
        tokens = cut(part)
        pool.append(pa.total_allocated_bytes() - before)
        assert len(tokens.flatten()) <= encode.BYTES_PER_STEP
        return tokens

    got = encode.coded_texts(texts, watched, ids, 600)
    assert got.to_pylist() == [[k % 50 if k % 50 < 40 else vocab.UNKNOWN_ID for k in range(600)]] * 2000
    assert len(pool) > 5 and max(pool) < 2000 * 1000 * 4


@pytest.mark.parametrize("name", ["collate_batches", "encode_inputs", "encode_labels"])
def test_a_task_codes_a_limited_number_of_rows(spark, monkeypatch, name):
    dealt = []
    monkeypatch.setattr(queries, "spread", lambda df, **limits: dealt.append(scaling.spread(df, small=10, **limits)) or dealt[-1])
    want = sorted(map(str, queries.QUERIES[name](spark, "/root/testdata/sf0.001").collect()))
    monkeypatch.setattr(queries, "CODED_ROWS", 40)
    dealt.clear()
    assert sorted(map(str, queries.QUERIES[name](spark, "/root/testdata/sf0.001").collect())) == want
    pieces = dealt[0].groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in pieces) <= 50
