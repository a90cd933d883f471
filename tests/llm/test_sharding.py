from collections import Counter

import duckdb
import pytest

from hackney.llm import sharding as S
from tests.llm.helpers import documents


def test_shards_own_as_many_slots_up_to_one():
    owner = S.fill([f"s{i}" for i in range(7)], 101)
    counts = Counter(owner).values()
    assert len(owner) == 101 and max(counts) - min(counts) <= 1


def test_turns_follow_preferences():
    """The same by a plain simulation of turns over whole permutations."""
    names, size = ["a", "b", "c"], 13
    prefs = []
    for n in names:
        offset, skip = S._digest(f"{n}/offset") % size, S._digest(f"{n}/skip") % (size - 1) + 1
        prefs.append([(offset + j * skip) % size for j in range(size)])
        assert sorted(prefs[-1]) == list(range(size))
    owner, turn = {}, 0
    while len(owner) < size:
        slot = next(s for s in prefs[turn % 3] if s not in owner)
        owner[slot] = turn % 3
        turn += 1
    assert S.fill(names, size) == [owner[s] for s in range(size)]


def test_removing_a_shard_moves_little():
    names = [f"s{i}" for i in range(10)]
    before, after = S.fill(names, 1009), S.fill(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(before, after, strict=True) if a != 9)
    assert moved < 0.1 * 1009


def test_invalid_tables():
    for shards, size in (([], 7), (["a"], 8), (["a", "a"], 7), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            S.fill(shards, size)


def test_place_equals_sql_with_nulls_repeats_and_clashes(spark):
    rows = [(None, "x"), (0, "a"), (0, "a"), (-5, None), (2 ** 62, ""), *[(i, "t") for i in range(50)]]
    names = ["p", "q", "r"]
    placed = S.place(documents(spark, rows), "doc_id", names, 31)
    assert set(placed.columns) >= {"doc_id", "slot", "shard_id", "n_tokens"} and placed.count() == len(rows)
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint)")
    con.executemany("insert into documents values (?)", [[r[0]] for r in rows])
    want = con.execute(S.oracle("doc_id", "documents", names, 31)).fetchall()
    key = lambda t: (t[0] is None, t[0] or 0, t[1])
    got = [tuple(r) for r in placed.select("doc_id", "slot", "shard_id").collect()]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_empty_and_write(spark, tmp_path):
    empty = documents(spark, [])
    assert S.place(empty, "doc_id").count() == 0
    placed = S.place(documents(spark, [(i, "t") for i in range(40)]), "doc_id", ["a", "b"], 7).select("doc_id", "shard_id")
    S.write_shards(placed, str(tmp_path / "out"), files_per_shard=2)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 40


def test_native_plan(spark):
    plan = S.place(documents(spark, [(1, "t")]), "doc_id")._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan.split("Physical Plan")[-1].replace("PythonRDD", "")
