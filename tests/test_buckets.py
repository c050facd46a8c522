"""Joins without a shuffle of the fact, and dense ids looked up where the rows lie."""

import re
import uuid
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from stridebase.operators import dense_ids
from stridebase.plans import explore, star_queries
from stridebase.plans.warehouse import Warehouse


@contextmanager
def no_automatic_broadcasts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same_rows(left, right):
    columns = sorted(left.columns)
    left, right = left.select(*columns), right.select(*columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


@pytest.fixture
def layers(spark, warehouse, shared):
    name = "t" + uuid.uuid4().hex[:8]
    made = Warehouse(warehouse.races, f"{shared}/{name}", f"{name}_")
    yield made
    made.drop()


def test_the_largest_join_has_no_exchange_of_the_fact(spark, warehouse):
    with no_automatic_broadcasts(spark):
        rare = warehouse.fct_by_athlete.join(warehouse.dim_athlete_bucketed, "athlete_key", "left")
        plan = executed(rare)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        plain = executed(warehouse.fct_results.join(warehouse.dim_athlete, "athlete_key", "left"))
        assert plain.count("Exchange") == 2
        assert same_rows(warehouse.star_wide(), star_queries.star_wide(warehouse.star))
    assert same_rows(warehouse.star_wide(), star_queries.star_wide(warehouse.star))


def test_a_hot_athlete_is_split(spark, warehouse, layers):
    hot = warehouse.dim_athlete.orderBy("athlete_key").first()["athlete_key"]
    taken = F.xxhash64("result_id") % 10 < 2
    layers.__dict__["fct_results"] = warehouse.fct_results.withColumn("athlete_key", F.when(taken, hot).otherwise(F.col("athlete_key")))
    assert hot in [r[0] for r in layers.frequent_athletes.collect()]
    assert layers.frequent_athletes.count() < layers.buckets
    assert layers.fct_by_athlete.where(F.col("athlete_key") == hot).isEmpty()
    total = layers.fct_results.count()
    assert layers.fct_by_athlete.count() + layers.fct_of_frequent.count() == total
    largest = layers.fct_by_athlete.groupBy("athlete_key").count().agg(F.max("count")).first()[0]
    assert largest <= total / layers.buckets
    assert same_rows(layers.star_wide(), star_queries.star_wide(layers.star))


def test_refreshed_buckets(spark, layers):
    first = layers.fct_by_athlete.count()
    del layers.__dict__["fct_by_athlete"]
    assert layers.fct_by_athlete.count() == first
    described = spark.sql(f"DESCRIBE EXTENDED {layers.schema('serving')}.fct_by_athlete")
    assert described.where("col_name = 'Num Buckets'").first()["data_type"] == str(layers.buckets)


def test_dense_ids_are_looked_up_where_the_rows_lie(spark, warehouse, monkeypatch):
    rows = warehouse.explore_v1
    with no_automatic_broadcasts(spark):
        looked_up = explore.explore_silver(rows)
        assert not re.findall(r"(?<!Broadcast)Exchange", executed(looked_up))
        monkeypatch.setattr(dense_ids, "LOOKUP_BYTES", 0)
        shuffled = explore.explore_silver(rows)
        assert "SortMergeJoin" in executed(shuffled)
        assert same_rows(looked_up, shuffled)
