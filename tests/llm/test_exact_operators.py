"""Operators with exact results, against brute force on small made-up tables."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from briefloom.llm import exchange, mixing
from briefloom.llm import jaccard_join as jaccard_join_module
from briefloom.llm.chat_format import escape, format_chats, op8_chat_format, read_loss, read_turns, unescape
from briefloom.llm.decontamination import decontaminated, op7_decontamination
from briefloom.llm.helpers import components, running_total
from briefloom.llm.jaccard_join import jaccard_join, keep_first
from briefloom.llm.kernels import Words, slices
from briefloom.llm.mixing import mix_sources, op1_mix_sources
from briefloom.llm.quality_rules import BIT, ablation, ledger, op6_quality_rules, rejected
from briefloom.llm.substring_dedup import substring_dedup

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def corpus(seed=1, n=60, vocabulary=400):
    """Texts with copies, near copies, shared passages, odd white space, nulls and repeated rows."""
    rng = random.Random(seed)
    new = lambda k: [f"w{rng.randrange(vocabulary)}é"[: rng.choice((3, 4, 5))] for _ in range(k)]
    passage = new(50)
    texts = []
    for i in range(n):
        kind = i % 6
        if kind < 2 or not texts:
            own = new(rng.randrange(1, 150))
        elif kind == 2:
            own = words(rng.choice([t for t in texts if t]))
        elif kind == 3:
            own = words(rng.choice([t for t in texts if t]))
            for _ in range(rng.randrange(1, 4)):
                own[rng.randrange(len(own))] = "changed"
        elif kind == 4:
            own = new(20) + passage + new(10)
        else:
            own = new(5) * 12
        texts.append(rng.choice((" ", "\n", "  ", "\t")).join(own))
    texts += [None, "", " \n\t", "one", "One", "a b c", "x y z", "Ü ß 漢字 " * 30]
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return rows + [rows[3], rows[3], (None, texts[4], None, None, None), (5, texts[9], "en", "s1", 3)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(5)


def clashing(df):
    """The same rows with columns named like the operators' own."""
    names = ("sig", "block", "bucket", "root", "size", "target", "epoch", "taken", "fail_bits", "n_words", "kept", "shuffle", "queue")
    return df.select("*", *[F.lit("x").alias(c) for c in names])


def test_words_and_windows_are_those_of_the_texts():
    texts = [r[1] for r in corpus()]
    w = Words(pa.array(texts, pa.string()))
    assert [int(c) for c in w.counts] == [len(words(t)) for t in texts]
    flat = [x for t in texts for x in words(t)]
    assert len({*zip(flat, w.hashes.tolist())}) == len(set(flat)) == len(set(w.hashes.tolist()))
    at, hashes = w.windows(7)
    brute, start = [], 0
    for t in texts:
        own = words(t)
        brute += [(start + i, tuple(own[i : i + 7])) for i in range(len(own) - 6)]
        start += len(own)
    assert at.tolist() == [b[0] for b in brute]
    assert len(set(zip(hashes.tolist(), (b[1] for b in brute)))) == len(set(hashes.tolist())) == len({b[1] for b in brute})


def test_case_is_folded_for_ascii_only():
    a = Words(pa.array(["Ab É", "aB é"], pa.string()), fold_case=True).hashes
    assert a[0] == a[2] and a[1] != a[3]


def test_slices_cover_all_rows():
    texts = pa.array(["a" * 10, None, "", "b" * 50, "c"], pa.string())
    assert [r for i, j in slices(texts, 12) for r in range(i, j)] == list(range(5))


def test_packing_is_reversible():
    values = np.unique(np.random.default_rng(0).integers(0, 2**64, 5000, np.uint64))
    assert (exchange.unpack(exchange.pack(values)) == values).all()
    present, first, last = exchange.cut(values, 7)
    assert present.tolist() == list(range(7)) and last[-1] == len(values) and (first[1:] == last[:-1]).all()


def test_running_total(spark):
    rows = [(i * 7 % 50, i) for i in range(200)]
    got = running_total(spark.createDataFrame(rows, "k long, v long").repartition(6), ["k", "v"], "v", "t", 5).collect()
    total = 0
    for k, v, t in sorted((r["k"], r["v"], r["t"]) for r in got):
        total += v
        assert t == total


def test_components_of_a_chain_a_star_and_a_pair(spark):
    chain = [(f"c{i:02d}", f"c{i + 1:02d}") for i in range(40)]
    star = [("s50", f"s{i:02d}") for i in range(40)]
    links = spark.createDataFrame([*chain, *star, ("x", "y"), ("y", "x")], "a string, b string")
    got = {r["node"]: r["root"] for r in components(links, "a", "b").collect()}
    assert got == {**{f"c{i:02d}": "c00" for i in range(41)}, **{f"s{i:02d}": "s00" for i in range(40)}, "s50": "s00", "x": "x", "y": "x"}


# substring dedup


def brute_substrings(rows, width):
    starts = Counter(tuple(w[i : i + width]) for w in (words(r[1]) for r in rows) for i in range(len(w) - width + 1))
    out = []
    for r in rows:
        w = words(r[1])
        gone = set()
        for i in range(len(w) - width + 1):
            if starts[tuple(w[i : i + width])] > 1:
                gone |= set(range(i, i + width))
        out.append((r[0], " ".join(x for i, x in enumerate(w) if i not in gone), len(w), len(gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("width", [1, 8, 35])
def test_substring_dedup(spark, docs, width, monkeypatch):
    monkeypatch.setattr(exchange, "sizes", lambda total: (4, 5))
    got = substring_dedup(clashing(docs), width, carry=("source", "text")).collect()
    assert sorted([(r["doc_id"], r["kept_text"], r["n_words"], r["n_removed"]) for r in got], key=repr) == brute_substrings(corpus(), width)
    for r in got:
        assert sum(s["last"] - s["first"] + 1 for s in r["removed"]) == r["n_removed"]
        assert all(a["last"] + 1 < b["first"] for a, b in zip(r["removed"], r["removed"][1:]))
        assert r["n_words"] == len(words(r["text"]))


def test_what_stays_keeps_its_spacing(spark):
    shared = " ".join(f"s{i}" for i in range(8))
    texts = [f"  One\u00e9 line\n\n{shared}\nlast  line \n", f"{shared}\tother\nwords", f"end of\n{shared}", "a\n b ", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["kept_text"] for r in substring_dedup(docs, 8, spacing=True).collect()}
    assert got == {0: "  One\u00e9 line\n\nlast  line", 1: "other\nwords", 2: "end of", 3: "a\n b ", 4: ""}


def test_substring_dedup_of_nothing(spark):
    assert substring_dedup(spark.createDataFrame([], DOCS)).collect() == []
    assert [r["kept_text"] for r in substring_dedup(spark.createDataFrame([(1, None, None, None, None)], DOCS)).collect()] == [""]


# n-gram Jaccard join


def shingles(text, k):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute_components(rows, k, percent):
    sets = [shingles(r[1], k) for r in rows]
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        least[find(i)].append(r[0])
    low = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    return sorted([(r[0], len(sets[i]), low[find(i)]) for i, r in enumerate(rows)], key=repr)


@pytest.mark.parametrize("seed, k, percent", [(1, 4, 85), (2, 5, 80), (3, 2, 60), (4, 1, 50)])
def test_jaccard_join(spark, seed, k, percent, monkeypatch):
    monkeypatch.setattr(exchange, "sizes", lambda total: (3, 4))
    rows = corpus(seed, 72, 60 if k < 3 else 400)
    got = jaccard_join(clashing(spark.createDataFrame(rows, DOCS).repartition(4)), k, percent).collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute_components(rows, k, percent)


def test_a_chain_of_edits_hangs_together(spark):
    """Every text is near the next one only, so pivots alone do not join them."""
    base, rows = [f"b{i}" for i in range(60)], []
    for i in range(30):
        base[2 * i] = f"n{i}"
        rows.append((100 - i, " ".join(base), None, None, None))
    got = jaccard_join(spark.createDataFrame(rows, DOCS), 1, 90).collect()
    assert {r["component_id"] for r in got} == {71}


def test_outsiders_meet_the_list_and_members_do_not_meet_each_other(spark, monkeypatch):
    """5,000 members of one component, one of another and two of a third in one list: 3 * 5,000 + 2 pairs."""
    monkeypatch.setattr(jaccard_join_module, "LIST_PART", 700)
    rows = [("big", f"m{i:05}") for i in range(5000)] + [("one", "o1"), ("two", "t1"), ("two", "t2")]
    entries = spark.createDataFrame([(7, root, sig) for root, sig in rows], "token long, root string, sig string")
    pairs = jaccard_join_module._outsiders(entries).select("a.sig", "b.sig").toDF("a", "b").collect()
    got = [frozenset(r) for r in pairs]
    kinds = Counter(frozenset(s[0] for s in p) for p in got)
    assert len(got) == len(set(got)) and kinds == {frozenset("mo"): 5000, frozenset("mt"): 10000, frozenset("ot"): 2}


def test_keep_first_leaves_one_row_of_a_group(spark):
    rows = corpus()[:-1]  # without two texts under one id, which have no brute-force name
    kept = keep_first(clashing(spark.createDataFrame(rows, DOCS)), 4, 85)
    got = [r["doc_id"] for r in kept.collect() if words(r["text"])]
    assert {"root", "sig", "doc_id", "n_chars"} <= set(kept.columns)
    assert sorted(got) == sorted({low for _, n, low in brute_components(rows, 4, 85) if n})
    assert kept.count() - len(got) == sum(not words(r[1]) for r in rows)


def test_jaccard_join_of_nothing(spark):
    assert jaccard_join(spark.createDataFrame([], DOCS)).collect() == []
    assert jaccard_join(spark.createDataFrame([(1, " ", None, None, None)], DOCS)).collect()[0] == (1, 0, 1)


# quality rules


def brute_rules(text):
    t = text or ""
    w = words(t)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {k for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in t.split("\n") if words(x)]
    n = len(w)
    base = n < 20 or 100 * len(covered) > 30 * n
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), base)


def test_quality_rules(spark, docs):
    got = op6_quality_rules(clashing(docs).drop("n_words", "kept", "fail_bits")).collect()
    want = sorted([(r[0], *brute_rules(r[1])) for r in corpus()], key=repr)
    assert sorted([tuple(r)[:7] for r in got], key=repr) == want
    assert not any(r["kept"] and r["base_failed"] for r in got)
    assert op6_quality_rules(docs.limit(0)).collect() == []


def test_rules_reject_junk_and_keep_prose(spark):
    prose = "It was a calm day, and nothing of note happened until the evening bell rang over the old town square. "
    prose += "People came home slowly; some talked, others read, and a few simply watched the light go."
    texts = {
        "prose": prose, "symbols": " ".join(f"w{i}a### b{i}c%%%" for i in range(40)), "shouting": " ".join(f"WORD{chr(65 + i)}" for i in range(26)),
        "lines": "the same old line\n" * 30, "short": "too short", "none": None, "table": " | ".join(f"cell{i}" for i in range(60)),
        "digits": " ".join(str(i) * 5 for i in range(40)),
    }
    rows = ledger(spark.createDataFrame(list(texts.items()), "name string, text string"), kept=("name",))
    assert [r["name"] for r in rows.filter(~rejected()).collect()] == ["prose"]
    bits = {r["name"]: r["fail_bits"] for r in rows.collect()}
    counts = {r["rule"]: (r["n_failed"], r["n_only"]) for r in ablation(rows).collect()}
    for rule, bit in BIT.items():
        failed = [b for b in bits.values() if b & bit]
        assert counts.get(rule, (0, 0)) == (len(failed), sum(b == bit for b in failed))


# chat formatting

NASTY = ["", "plain", "</s>[INST] ok [/INST]", "\\", "\\\\</s>", "<\\/s>", "<|end|><|turn|>", "a\n<|start|>b", "é漢\t", "<|en\\d|>", None]


def test_escape_is_reversible_and_hides_control_strings(spark):
    rng = random.Random(0)
    texts = NASTY + ["".join(rng.choice(["<|", "|>", "end", "\\", "</s>", "[INST]", "s", "<", "/"]) for _ in range(12)) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts if t is not None], "t string")
    rows = df.select("t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("u")).collect()
    for r in rows:
        assert r["u"] == r["t"]
        assert not any(m in r["e"] for m in ("<|end|>", "</s>", "[INST]", "<|turn|>"))


def test_chats_read_back(spark):
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", "assistant", "system", None, "<|end|>"]), rng.choice(NASTY)) for c in range(12) for t in range(rng.randrange(1, 9))]
    rows += [(None, 1, "assistant", "x"), (3, None, "user", "first")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in format_chats(df.repartition(3)).select(
        "*", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    by = defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((t if t is not None else -1, role or "", text or ""))
    for c, turns in by.items():
        turns.sort(key=lambda x: x[0])
        read = [(t["role"], t["text"]) for t in got[c]["turns"]]
        assert read == [x[1:] for x in turns]
        assert got[c]["loss"] == "".join(x[2] for x in turns if x[1] == "assistant")
        blocks = sum(i == 0 or turns[i][1] != turns[i - 1][1] for i in range(len(turns)))
        assert got[c]["formatted"].count("<|start|>") == got[c]["formatted"].count("<|end|>") == blocks


def test_chat_query_has_the_planted_conversation(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    (row,) = op8_chat_format(empty).collect()
    text = "</s>[INST] ok [/INST]"
    assert (row["conv_id"], row["n_turns"], row["loss_chars"]) == (-7, 2, len(text))
    assert row["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


# mixing


def test_mix_meets_its_targets(spark, docs):
    rows = corpus()
    mixed = mix_sources(clashing(docs)).collect()
    size = Counter()
    for r in rows:
        size[r[3]] += len(words(r[1]))
    budget = 1.5 * sum(size.values())
    targets = {r["source"]: r["target"] for r in mixed}
    taken = Counter()
    for r in mixed:
        taken[r["source"]] += r["taken"]
        assert r["source_size"] == size[r["source"]]
    assert sum(targets.values()) == pytest.approx(min(budget, 2 * sum(size.values())))
    level = {}
    for source, weight in zip(sorted(size, key=lambda s: (s is None, s)), (3, 1, 2) * 9):
        assert targets[source] <= 2 * size[source]
        if targets[source] < 2 * size[source]:
            level[source] = targets[source] / weight
        assert abs(taken[source] - targets[source]) <= 1
    assert max(level.values()) == pytest.approx(min(level.values()))
    for source, weight in zip(sorted(size, key=lambda s: (s is None, s)), (3, 1, 2) * 9):
        assert source in level or 2 * size[source] <= weight * max(level.values()) + 1e-6
    stream = sorted((r["position"], r["taken"]) for r in mixed if r["taken"])
    assert stream[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(stream, stream[1:]))


def test_mix_is_the_same_whatever_the_partitions(spark, docs):
    a, b = (sorted(map(tuple, op1_mix_sources(d).collect()), key=repr) for d in (docs, docs.repartition(2)))
    assert a == b and all(taken <= 2 * size for _, size, _, _, taken in a)
    assert Counter((i, n) for i, n, *_ in a) == Counter((r["doc_id"], len(words(r["text"] or ""))) for r in docs.collect())


def test_mix_of_rows_that_share_an_id(spark, monkeypatch):
    """Rows with one id or none stay rows of their own; equal rows are dealt whole copies, in stretches."""
    monkeypatch.setattr(mixing, "STRETCH", 3)
    rows = [(1, "a b c", None, "x", None), (1, "a b c d", None, "y", None), (None, "e f", None, "x", None), (None, "g h i", None, "x", None)]
    rows += [(2, "same words again", None, "y", None)] * 10
    got = op1_mix_sources(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r["doc_id"], r["size"]) for r in got if r["doc_id"]) == sorted((r[0], len(words(r[1]))) for r in rows if r[0])
    assert sorted(r["size"] for r in got if r["doc_id"] is None) == [2, 3]
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    taken = Counter()
    for r in got:
        taken[r["target"]] += r["taken"]
    assert all(abs(target - n) <= 1 for target, n in taken.items()) and len(taken) == 2
    copies = [r["taken"] for r in got if r["doc_id"] == 2]
    assert sum(n % 3 != 0 for n in copies) <= 2 and max(copies) - min(copies) <= 3


def test_mix_of_nothing(spark):
    assert mix_sources(spark.createDataFrame([], DOCS)).collect() == []
    (row,) = mix_sources(spark.createDataFrame([(1, None, None, None, None)], DOCS)).collect()
    assert (row["size"], row["target"], row["taken"]) == (0, 0.0, 0)


# decontamination

QUESTION = "A farmer named Alice has 12 apples and gives 5 kg of them to her brother Bob before lunch on Monday."
OTHER = "A farmer named Carol has 90 apples and gives 7 kg of them to her brother Dave before lunch on Friday."
MIXED = "A farmer named Alice has 12 apples and gives 12 kg of them to her brother Alice before lunch on Monday."


def test_reparameterised_questions_are_found(spark):
    benchmark = spark.createDataFrame([(1, QUESTION), (2, None), (None, QUESTION), (3, ""), (4, "too short")], "item_id long, text string")
    rows = [
        (1, "Some words come first. " + QUESTION + " And some come after it."), (2, "Intro text here, then: " + OTHER), (3, None), (4, ""),
        (5, "A text about a farmer and his apples, which has nothing to do with any question."), (6, MIXED), (1, "the same id but clean"),
        (7, QUESTION.upper().replace(" ", "  ")), (None, OTHER),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("hash", F.lit("x")).withColumn("item_id", F.lit(9))
    got = {(r["doc_id"], r["item_id"]): r["changed_slots"] for r in op7_decontamination(docs, benchmark).collect()}
    assert {k for k in got if k[0] != 7} == {(1, 1), (2, 1), (None, 1)}  # 6: one value stands for two
    assert got[1, 1] == 0 and got[2, 1] > 0
    clean = sorted(str(r["text"]) for r in decontaminated(docs, benchmark).filter("doc_id is distinct from 7").collect())
    assert clean == sorted(str(t) for i, t in rows if t in (None, "", rows[4][1], MIXED, rows[6][1]))


def test_large_benchmarks_take_the_shuffled_join(spark):
    benchmark = spark.createDataFrame([(1, QUESTION)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "Before. " + OTHER), (2, "clean text")], "doc_id long, text string")
    assert [r["doc_id"] for r in decontaminated(docs, benchmark, max_broadcast_rows=0).collect()] == [2]
    assert op7_decontamination(docs.limit(0), benchmark).collect() == []
    assert op7_decontamination(docs, benchmark.limit(0)).collect() == []


def test_excerpts_of_long_items_are_found(spark):
    """Less than half of an item, but far more than chance: 100 of 300 words, 25 of 59; not 10 of 300."""
    long, middle = ([f"{p}{i}x" for i in range(n)] for p, n in (("long", 300), ("mid", 59)))
    benchmark = spark.createDataFrame([(1, " ".join(long)), (2, " ".join(middle))], "item_id long, text string")
    rows = [(1, long[120:220]), (2, middle[30:55]), (3, long[50:60]), (4, [f"{w} other" for w in long])]
    docs = spark.createDataFrame([(i, "Words before. " + " ".join(w) + " words after.") for i, w in rows], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["covered"] for r in op7_decontamination(docs, benchmark).collect()}
    assert got == {(1, 1): 100, (2, 2): 25}
    assert sorted(r["doc_id"] for r in decontaminated(docs, benchmark).collect()) == [3, 4]


INSTRUCTION = "Read the following passage carefully and then choose the best answer from the options given below"


def test_common_wording_of_many_items_is_no_excerpt(spark):
    """Of items that begin alike only own words tell; copies of an item do not make its words common."""
    own = {i: " ".join(f"item{i}word{k}" for k in range(45)) for i in range(6)}
    items = [(i, f"{INSTRUCTION}: {text}") for i, text in own.items()] + [(10 + k, own[5]) for k in range(6)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    excerpt = " ".join(own[3].split()[5:30])
    rows = [(1, f"The form says: {INSTRUCTION}."), (2, f"Before. {excerpt} After."), (3, f"Words. {INSTRUCTION}: {own[4]}"), (4, own[5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in op7_decontamination(docs, benchmark).collect()}
    assert got == {(2, 3), (3, 4), (4, 5), *((4, 10 + k) for k in range(6))}


EQUAL = "Tom buys 2 apples at 2 dollars each from the stall and wants to know how much he paid for all."
TWICE = "The old ship carries 40 men and 40 barrels of salt, " + " ".join(f"then word{i}" for i in range(20))
DENSE = "Add 12 34 56 78 90 11 and 22 33 44 55 66 77 to Anna Bert Carl Dora Emil Fritz Gustav Hanna."


def test_conflicting_slots_and_other_letter_case(spark):
    items = {1: QUESTION, 2: EQUAL, 3: TWICE, 4: DENSE}
    benchmark = spark.createDataFrame(list(items.items()), "item_id long, text string")
    found = [
        (1, 1, QUESTION.upper().replace(" ", "  "), 0), (2, 1, QUESTION.title(), 0), (3, 1, QUESTION.lower(), 0),
        (4, 1, QUESTION.lower().replace("12", "17").replace(" 5 ", " 9 "), 2), (5, 2, EQUAL.replace("2 apples at 2", "3 apples at 7"), 2),
        (6, 3, TWICE.replace("40 barrels", "41 barrels"), 1), (7, 4, DENSE, 0), (8, 4, DENSE.upper(), 0),
    ]
    rows = [(d, f"Words before. {text} Words after.") for d, _, text, _ in found] + [(9, MIXED), (10, "12 34 56 apples")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["changed_slots"] for r in op7_decontamination(docs, benchmark).collect()}
    assert got == {(d, i): changed for d, i, _, changed in found}
    assert sorted(r["doc_id"] for r in decontaminated(docs, benchmark, max_broadcast_rows=0).collect()) == [9, 10]
