from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stridebase.llm.sharding import shard_by_bytes, utf8_size

SCHEMA = "id long, size long"


def brute_force(sizes, shards):
    """Shard of every row in order, by the middle of its bytes."""
    total, at, out = sum(sizes), 0, []
    for size in sizes:
        out.append(min((2 * at + size) * shards // (2 * total), shards - 1) if total else 0)
        at += size
    return out


def check(rows, shards):
    ordered = sorted(rows, key=lambda r: (r["first_byte"], r["shard"], r["slot"]))
    slots = defaultdict(list)
    for r in ordered:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    sizes = [max(r["size"] or 0, 0) for r in ordered]
    assert [r["shard"] for r in ordered] == brute_force(sizes, shards)
    assert [r["first_byte"] for r in ordered] == [sum(sizes[:i]) for i in range(len(sizes))]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-3, 40)), st.one_of(st.none(), st.integers(0, 9), st.just(500))), max_size=60), st.integers(1, 9))
def test_against_brute_force(spark, rows, shards):
    got = shard_by_bytes(spark.createDataFrame(rows, SCHEMA), ["id"], "size", shards).collect()
    assert len(got) == len(rows)
    check(got, shards)
    in_order = [r["id"] for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))]
    assert in_order == sorted(in_order, key=lambda i: (i is not None, i or 0))


def test_one_hot_key_is_spread_over_all_shards(spark):
    rows = spark.range(2000).select(F.lit(7).cast("long").alias("id"), F.lit(10).cast("long").alias("size"))
    got = shard_by_bytes(rows, ["id"], "size", 8).collect()
    check(got, 8)
    assert {r["shard"]: 0 for r in got}.keys() == set(range(8))


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert shard_by_bytes(empty, ["id"], "size", 3).collect() == []
    rows = spark.createDataFrame([(1, 5, 9, "x", 1)], "id long, size long, shard int, _tie string, _piece int")
    got = shard_by_bytes(rows, ["id"], "size", 3)
    assert got.columns == ["id", "size", "_tie", "_piece", "shard", "slot", "first_byte"]
    assert got.first()["_tie"] == "x"


def test_more_shards_than_rows(spark):
    got = shard_by_bytes(spark.createDataFrame([(1, 4), (2, 4)], SCHEMA), ["id"], "size", 8).collect()
    check(got, 8)


@pytest.mark.parametrize("text, size", [(None, 0), ("", 0), ("é", 2), ("x" * 100_000, 100_000)])
def test_utf8_size(spark, text, size):
    assert spark.createDataFrame([(text,)], "t string").select(utf8_size(F.col("t"))).first()[0] == size


def test_no_python_in_the_plan(spark):
    df = shard_by_bytes(spark.createDataFrame([(1, 4), (2, 4)], SCHEMA), ["id"], "size", 2)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
