"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from oracle.duckdb_sql import ORACLE
from stridebase.plans import explore, gold, marts, reports, star_queries
from stridebase.plans.silver import clean_results
from tests.conftest import SF_DIR

QUERIES = {name: query for name, query in contract.queries().items() if name in ORACLE}


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_no_python_workers_and_no_cross_joins(spark, name):
    text = executed(QUERIES[name](spark, SF_DIR))
    for node in ("EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Scan ExistingRDD"):
        assert node not in text


def test_cleaning_is_one_stage_and_parses_once(warehouse):
    text = executed(clean_results(warehouse.races))
    assert "Exchange" not in text
    assert len(re.findall(r"regexp_replace\(athlete_average_speed", text)) == 1
    assert text.count("RLIKE(performance_seconds_clock") == 1
    assert "IsNotNull(athlete_performance)" in text.split("PushedFilters")[1]


def test_cleaning_reads_only_what_is_used(warehouse):
    text = executed(clean_results(warehouse.races).groupBy("year_id").agg(F.max("year_of_event")))
    read = text.split("ReadSchema: ")[1]
    assert "athlete_club" not in read and "event_name" not in read and "athlete_gender" not in read


def test_dimensions_reduce_before_the_shuffle(warehouse):
    for build in (gold.dim_athlete, gold.dim_event, gold.dim_time):
        text = executed(build(warehouse.silver))
        assert text.count("Exchange") == 1
        assert "partial_max" in text


def test_fact_needs_no_shuffle(warehouse):
    assert "Exchange" not in executed(gold.fct_results(warehouse.silver))


def test_rollup_reduces_before_the_join(spark, warehouse):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = executed(marts.mart_top_countries(warehouse.fct_results, warehouse.dim_athlete))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    join = text.index("SortMergeJoin")
    assert "partial_sum(performance_seconds" in text[join:]  # below the join
    assert "Batched: true" in text


def test_top_k_is_no_full_sort(warehouse):
    mart = marts.mart_fastest_athletes(warehouse.fct_results, warehouse.dim_athlete, warehouse.dim_event)
    assert "TakeOrderedAndProject" in executed(mart)
    top = star_queries.top_country(warehouse.mart_top_countries)
    assert "TakeOrderedAndProject" in executed(top)


def test_reports_on_both_variants_scan_once(spark, warehouse):
    for build in (reports.speed_stats, reports.conversion_failures, reports.cleaning_report):
        assert executed(build(warehouse.races)).count("Scan parquet") == 1


def test_no_plan_depends_on_the_number_of_cores(spark):
    assert "REPARTITION_BY_NUM" not in executed(QUERIES["bronze_races"](spark, SF_DIR))


def test_exploratory_rows_are_cleaned_once(spark, warehouse):
    for rows in (explore.explore_rows(warehouse.races, explore.V1), explore.explore_rows(warehouse.races, explore.V2)):
        text = executed(rows)
        assert text.count("Scan parquet") == 1 and "Exchange" not in text
    with_ids = executed(explore.explore_silver(warehouse.explore_v1))
    assert with_ids.count("Scan parquet") == 4  # the stored rows and three lists of ranks
    assert "RLIKE" not in with_ids and "regexp" not in with_ids  # nothing is cleaned again


def test_stored_marts_are_not_sorted(warehouse):
    assert "rangepartitioning" not in executed(marts.mart_top_countries(warehouse.fct_results, warehouse.dim_athlete))
