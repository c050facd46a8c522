"""Mergeable states against batch runs over all results: any order of landing, replays, compaction, empty batches."""

import itertools
import os
import uuid

import pytest
from pyspark.sql import functions as F

from stridebase.plans import gold, marts, star_queries
from stridebase.plans.silver import SILVER_SCHEMA, clean_results
from stridebase.plans.warehouse import StreamedWarehouse
from stridebase.streaming import states
from stridebase.streaming.states import ATHLETE_YEARS, ATHLETES, STATES, StateStore


def same_rows(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def parts(silver, n=3):
    """Parts in which an athlete and an event occur in several."""
    return [silver.where(F.pmod(F.col("year_of_event"), F.lit(n)) == i) for i in range(n)]


def check(store, warehouse):
    """Every answer from the states equals that of the batch tables."""
    assert same_rows(store.dim_athlete(), gold.dim_athlete(warehouse.silver))
    assert same_rows(store.dim_event(), gold.dim_event(warehouse.silver))
    assert same_rows(store.dim_time(), gold.dim_time(warehouse.silver))
    assert same_rows(store.mart_top_countries(), marts.mart_top_countries(warehouse.fct_results, warehouse.dim_athlete))
    assert same_rows(store.mart_fastest_athletes(), warehouse.mart_fastest_athletes)
    star = store.star(warehouse.fct_results)
    for question in (star_queries.kpi_overview, star_queries.gender_distribution, star_queries.speed_by_distance, star_queries.top_countries):
        for year in (None, 1998):
            assert same_rows(question(star, year), question(warehouse.star, year))
    for question in (star_queries.kpi_by_year, star_queries.participation):
        assert same_rows(question(star), question(warehouse.star))


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[::2])
def test_any_order_of_batches(spark, warehouse, shared, order):
    store = StateStore(spark, f"{shared}/{uuid.uuid4().hex}")
    for batch, part in enumerate(order):
        store.add(parts(warehouse.silver)[part], batch)
    check(store, warehouse)


def test_replayed_batches_and_compaction(spark, warehouse, shared):
    store = StateStore(spark, f"{shared}/{uuid.uuid4().hex}")
    pieces = parts(warehouse.silver, 4)
    for batch in (0, 1):
        store.add(pieces[batch], batch)
    store.add(pieces[1], 1)
    held = store.read(ATHLETE_YEARS)  # a reader from before
    before = held.agg(F.sum("results")).first()[0]
    store.compact(most_deltas=1)
    assert [p.rpartition("/")[2] for p in store.paths(ATHLETES)] == ["base-000000000001"]
    assert held.agg(F.sum("results")).first()[0] == before
    store.add(pieces[0], 0)  # in the base already
    store.add(pieces[1], 1)
    for batch in (2, 3):
        store.add(pieces[batch], batch)
    assert len(store.paths(ATHLETES)) == 3
    check(store, warehouse)
    store.compact(most_deltas=0)
    store.compact(most_deltas=0)
    assert [p.rpartition("/")[2] for p in store.paths(ATHLETES)] == ["base-000000000003"]
    assert sorted(os.listdir(f"{store.location}/athletes")) == ["base-000000000001", "base-000000000003", "delta-000000000002", "delta-000000000003"]
    check(store, warehouse)


def test_unfinished_deltas_and_bases_do_not_count(spark, warehouse, shared):
    store = StateStore(spark, f"{shared}/{uuid.uuid4().hex}")
    store.add(warehouse.silver, 0)
    for state in STATES:
        for kind in ("delta-", "base-"):
            state.reduce(warehouse.silver).write.parquet(f"{store.location}/{state.name}/{kind}000000000007")
            os.remove(f"{store.location}/{state.name}/{kind}000000000007/_SUCCESS")
    check(store, warehouse)


def test_before_the_first_batch(spark, shared):
    store = StateStore(spark, f"{shared}/{uuid.uuid4().hex}")
    assert store.dim_athlete().collect() == store.mart_top_countries().collect() == store.mart_fastest_athletes().collect() == []
    store.add(spark.createDataFrame([], SILVER_SCHEMA), 0)
    assert store.dim_time().collect() == []


def test_types_of_cleaned_results(warehouse):
    assert [(f.name, f.dataType) for f in clean_results(warehouse.races).schema] == [(f.name, f.dataType) for f in SILVER_SCHEMA]


def test_refreshes_read_only_what_is_new(spark, warehouse, shared, monkeypatch):
    base = f"{shared}/{uuid.uuid4().hex}"
    read = []

    def add(store, silver, batch, original=StateStore.add):
        read.append({f.removeprefix("file://") for f in silver.inputFiles()})
        original(store, silver, batch)

    monkeypatch.setattr(states.StateStore, "add", add)
    layers = StreamedWarehouse(spark, f"{base}/landing", f"{base}/layers", "t" + uuid.uuid4().hex[:8] + "_")
    for part in parts(warehouse.races):
        part.coalesce(2).write.mode("append").parquet(f"{base}/landing")
        layers.refresh()
        assert all("/silver/states/" in f for f in layers.store.mart_top_countries().inputFiles())
    layers.refresh()  # nothing new
    assert len(read) == 3
    assert not (read[0] & read[1] or read[0] & read[2] or read[1] & read[2])
    check(layers.store, warehouse)
    assert same_rows(layers.mart_top_countries, warehouse.mart_top_countries)
    assert same_rows(layers.mart_fastest_athletes, warehouse.mart_fastest_athletes)
    assert same_rows(star_queries.top10_fastest(layers.star, 1998), star_queries.top10_fastest(warehouse.star, 1998))
    layers.drop()


def test_deltas_are_reduced_before_the_shuffle(warehouse):
    for state in STATES[:-1]:
        plan = state.reduce(warehouse.silver)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "partial_" in plan
