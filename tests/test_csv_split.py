"""CSV read from byte ranges against one reader over the whole file."""

from __future__ import annotations

import csv
import io
import random

import pytest

from briefloom.sources.csv_split import HEAD, TAIL, WHOLE, pieces_of, read_split_csv, records_of

SCHEMA = "id long, text string, note string"


def written(path, rows, end="\n", order=("id", "text", "note"), quoting=csv.QUOTE_MINIMAL):
    buffer = io.StringIO(newline="")
    out = csv.DictWriter(buffer, order, lineterminator=end, quoting=quoting)
    out.writeheader()
    out.writerows({k: row.get(k, "x") for k in order} for row in rows)
    path.write_bytes(buffer.getvalue().encode())
    return path


def odd_rows(seed, n=120):
    rng = random.Random(seed)
    parts = ['"', '""', "\n", "\r\n", ",", "a", "ü漢", " ", '","', '"\n"', "long " * 30]
    cell = lambda: "".join(rng.choice(parts) for _ in range(rng.randrange(0, 7)))
    return [{"id": i, "text": cell(), "note": cell()} for i in range(n)]


def plain(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.mark.parametrize("size,end,seed", [(7, "\n", 1), (61, "\r\n", 2), (400, "\n", 3), (1 << 20, "\n", 4)])
def test_ranges_of_any_size_give_the_rows_of_the_whole(spark, tmp_path, size, end, seed):
    rows = odd_rows(seed, 25 if size < 50 else 120)
    path = written(tmp_path / "one.csv", rows, end)
    got = read_split_csv(spark, str(path), SCHEMA, na_values=(), range_bytes=size)
    assert plain(got) == sorted((r["id"], r["text"], r["note"]) for r in rows)
    if size == 400:
        assert got.rdd.getNumPartitions() > 10


def test_several_files_with_columns_in_other_orders(spark, tmp_path):
    rows = odd_rows(5)
    written(tmp_path / "a.csv", rows[:40])
    written(tmp_path / "b b.csv", rows[40:80], order=("note", "more", "id", "text"), quoting=csv.QUOTE_ALL)
    written(tmp_path / "c.csv", rows[80:], order=("text", "id", "note"))
    written(tmp_path / "none.csv", [])
    want = sorted((r["id"], r["text"], r["note"]) for r in rows)
    for limit in (10, 10**6):  # lines brought together by range, or the ranges broadcast
        assert plain(read_split_csv(spark, str(tmp_path), SCHEMA, (), range_bytes=300, max_broadcast_rows=limit)) == want


def test_cells_longer_than_many_ranges(spark, tmp_path):
    rows = [{"id": 1, "text": "x\n" * 5000, "note": "n"}, {"id": 2, "text": '"y"\n' * 3000, "note": ""}, {"id": 3, "text": "NA", "note": "z"}]
    path = written(tmp_path / "long.csv", rows)
    got = plain(read_split_csv(spark, str(path), SCHEMA, na_values=("", "NA"), range_bytes=900).fillna("-"))
    assert got == [(1, "x\n" * 5000, "n"), (2, '"y"\n' * 3000, "-"), (3, "-", "z")]


@pytest.mark.parametrize("body,words", [
    ('1,"a\n', "not closed"), ("1,a\n", "cells instead of"), ("1,a,b,c\n", "cells instead of"), ("one,a,b\n", "not a bigint"),
])
def test_malformed_files_are_errors(spark, tmp_path, body, words):
    (tmp_path / "bad.csv").write_text("id,text,note\n" + "0,ok,ok\n" * 50 + body)
    with pytest.raises(Exception, match=words):
        read_split_csv(spark, str(tmp_path / "bad.csv"), SCHEMA, range_bytes=100).collect()


def test_a_lacking_column_is_an_error(spark, tmp_path):
    written(tmp_path / "less.csv", odd_rows(1, 3), order=("id", "text"))
    with pytest.raises(ValueError, match="note"):
        read_split_csv(spark, str(tmp_path), SCHEMA)


def test_pieces_and_records_of_a_range():
    lines = ['end"', "a,b", '"c', 'd",e', 'f,"open', "still"]
    assert pieces_of(iter(lines), True) == [(HEAD, 'end"'), (TAIL, 'f,"open\nstill')]
    assert list(records_of(iter(lines), True, False)) == [["a", "b"], ["c\nd", "e"]]
    assert pieces_of(iter(["x", "y"]), True) == [(WHOLE, "x\ny")] and list(records_of(iter(["x"]), True, False)) == []
    assert pieces_of(iter(["h", "1"]), False) == [] and list(records_of(iter(["h", "1"]), False, True)) == [["1"]]


def test_small_ranges_share_tasks(spark, tmp_path):
    rows = [{"id": i, "text": f'a "b"\n{i}' * 50, "note": "n"} for i in range(1_500)]
    path = written(tmp_path / "one.csv", rows)
    back = read_split_csv(spark, str(path), SCHEMA, (), range_bytes=4_000)
    assert back.rdd.getNumPartitions() < 100 < path.stat().st_size // 4_000
    assert plain(back) == sorted((r["id"], r["text"], r["note"]) for r in rows)
