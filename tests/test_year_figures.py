"""Distinct counts from bitmaps, quantiles from sketches, and clicks that read one year's files."""

import os
import re
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from stridebase.operators import distinct_bitmaps, quantile_sketches
from stridebase.plans import star_queries, year_figures
from stridebase.plans.warehouse import Warehouse
from stridebase.sources.tables import intermediates


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("first, last", [(1992, 1998), (1993, 1993), (1994, 1996), (2050, 2060), (1998, 1992)])
def test_any_range_of_years(warehouse, first, last):
    years = warehouse.dim_time.where(F.col("year_of_event").between(first, last))
    rows = warehouse.fct_results.join(years, "year_id").join(warehouse.dim_athlete, "athlete_key")
    want = rows.agg(
        F.count_distinct("event_id"), F.count_distinct("athlete_key"), F.count_distinct("athlete_country"), F.count(F.lit(1)),
        F.round(F.avg("athlete_average_speed"), 2),
    ).first()
    assert tuple(year_figures.kpi_over_years(warehouse.year_figures, first, last).first()) == tuple(want)


def test_ranges_read_only_what_is_stored_per_year(warehouse):
    figures = warehouse.year_figures
    for question in (year_figures.kpi_over_years(figures, 1993, 1995), year_figures.kpi_up_to_each_year(figures)):
        assert question.inputFiles() and all("/serving/year_" in f for f in question.inputFiles())


def test_figures_outlive_the_run_that_built_them(spark, warehouse, shared):
    name = "t" + uuid.uuid4().hex[:8]
    layers = Warehouse(warehouse.races, f"{shared}/{name}", f"{name}_")
    layers.refresh()
    with intermediates(spark):
        first = [tuple(r) for r in year_figures.kpi_up_to_each_year(layers.year_figures).orderBy("up_to").collect()]
        rows = layers.star_wide().count()
    assert [tuple(r) for r in year_figures.kpi_up_to_each_year(layers.year_figures).orderBy("up_to").collect()] == first
    assert layers.star_wide().count() == rows
    layers.drop()


@pytest.mark.parametrize("seed", range(3))
def test_bitmaps_against_sets(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(int(g), None if n % 17 == 0 else int(n)) for g, n in zip(rng.integers(0, 4, 3000), rng.integers(1, 200_000, 3000))]
    df = spark.createDataFrame(rows, "g int, n long").repartition(5)
    bitmaps = distinct_bitmaps.construct(df, "n", "g")
    sets = {g: {n for x, n in rows if x == g and n is not None} for g in range(4)}
    assert {r["g"]: r["distinct_values"] for r in distinct_bitmaps.counted(bitmaps, "g").collect()} == {g: len(s) for g, s in sets.items()}
    some = distinct_bitmaps.merged(bitmaps.where("g in (1, 3)"))
    assert distinct_bitmaps.counted(some).first()[0] == len(sets[1] | sets[3])
    assert distinct_bitmaps.counted(distinct_bitmaps.construct(df.limit(0), "n")).first()[0] == 0
    edges = spark.createDataFrame([(n,) for n in (1, 32_768, 32_769, 65_536, 65_537, 1, None)], "n long")
    assert distinct_bitmaps.counted(distinct_bitmaps.construct(edges, "n")).first()[0] == 5


def test_sketches_of_batches_merge(spark):
    rng = np.random.default_rng(1)
    rows = [(int(g), float(v)) for g, v in zip(rng.integers(0, 3, 60_000), rng.normal(size=60_000) ** 3)] + [(7, 1.0), (7, 2.0), (7, 3.0), (8, None), (None, 5.0)]
    df = spark.createDataFrame(rows, "g int, v double").withColumn("batch", F.pmod(F.hash("v"), F.lit(9)))
    names = {"p25": 0.25, "p50": 0.5, "p99": 0.99}
    found = quantile_sketches.quantiles(quantile_sketches.merged(quantile_sketches.sketch(df, "v", "g", "batch"), "g"), names)
    errors = quantile_sketches.measured_rank_errors(df, "v", ["g"], found, names).collect()
    assert len(errors) == 15 and {r["g"] for r in errors} == {0, 1, 2, 7, None}
    assert max(r["error"] for r in errors) <= quantile_sketches.rank_error()
    small = {r["g"]: r for r in found.collect()}[7]
    assert (small["values"], small["p50"], small["p99"]) == (3, 2.0, 3.0)


def test_measured_errors_find_wrong_quantiles(spark):
    df = spark.range(1000).select(F.lit(1).alias("g"), F.col("id").cast("double").alias("v"))
    wrong = spark.sql("SELECT 1 AS g, 1000L AS values, 599.0D AS p50")
    assert quantile_sketches.measured_rank_errors(df, "v", ["g"], wrong, {"p50": 0.5}).first()["error"] == pytest.approx(0.099)


def test_a_click_reads_one_year(spark, warehouse):
    star = warehouse.star_by_year
    for question in (star_queries.kpi_overview, star_queries.top_countries, star_queries.gender_distribution, star_queries.speed_by_distance):
        df = question(star, 1998)
        assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", executed(df)), question
        plain = question(warehouse.star, 1998)
        assert df.exceptAll(plain).isEmpty() and plain.exceptAll(df).isEmpty()


def test_a_large_year_is_several_files(spark, warehouse, shared):
    name = "t" + uuid.uuid4().hex[:8]
    other = Warehouse(warehouse.races, f"{shared}/{name}", f"{name}_")
    one = warehouse.dim_time.first()["year_id"]
    fct = warehouse.fct_results.withColumn("year_id", F.when(F.rand(3) < 0.8, one).otherwise(F.col("year_id")))
    other.__dict__["fct_results"] = spark.range(0, 32, 1, 8).crossJoin(F.broadcast(fct)).drop("id")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32k")
    try:
        stored = other.fct_by_year
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    folder = [f for f in stored.inputFiles() if f"year_id={one}" in f]
    assert len(folder) > 1 and stored.count() == other.fct_results.count()
    assert len(os.listdir(f"{shared}/{name}/serving")) > 0
    other.drop()


def test_describe_skips_most_patterns_but_no_number(spark):
    from stridebase.operators.profiling import _castable

    texts = ["6d", " 1", "\t2", "+3", "-4", ".5", "1e3", "0x1p3", "inf", "NaN", "Infinity", "nan", "x1", "Tx", "é1", "", None, "ＩＮＦ", "９", "~1", "-inf"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    from stridebase.operators.profiling import CASTABLE

    plain = F.when(F.col("t").rlike(CASTABLE), F.col("t").try_cast("double"))
    rows = df.select(_castable(F.col("t")).cast("string").alias("a"), plain.cast("string").alias("b")).collect()
    assert [r["a"] for r in rows] == [r["b"] for r in rows]
