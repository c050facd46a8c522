"""The stored layers that queries share: they are built anew when they or the order tables are no longer the same."""

import os
import pathlib
import shutil
import subprocess
import sys
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from stridebase.plans.warehouse import order_warehouse
from stridebase.sources.tables import create_schema, refresh_table


def write_orders(spark, directory, results):
    """Order tables with so many results."""
    tables = {
        "customer": ([(1, 0, "BUILDING")], "c_custkey long, c_nationkey int, c_mktsegment string"),
        "part": ([(1, "red", "Brand#1", 3)], "p_partkey long, p_name string, p_brand string, p_size int"),
        "orders": ([(k, 1) for k in range(1, results + 1)], "o_orderkey long, o_custkey long"),
        "lineitem": (
            [(k, 1, 1, datetime(1995, 1, 1)) for k in range(1, results + 1)],
            "l_orderkey long, l_linenumber int, l_partkey long, l_shipdate timestamp",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{directory}/{name}.parquet")


@pytest.fixture
def orders(spark, tmp_path):
    write_orders(spark, tmp_path, 5)
    return tmp_path


def counted(spark, directory, query="country_counts"):
    return contract.queries()[query](spark, directory).collect()


def test_layers_are_shared_while_they_stand(spark, orders):
    w = order_warehouse(spark, str(orders))
    assert [r["results"] for r in counted(spark, str(orders))] == [5]
    assert order_warehouse(spark, str(orders)) is w


def test_directory_as_a_path(spark, orders):
    assert isinstance(orders, pathlib.Path)
    assert [r["results"] for r in counted(spark, orders)] == [5]


@pytest.mark.parametrize("gone", ["files", "schemas"])
def test_queries_after_the_layers_have_gone(spark, orders, gone):
    before = counted(spark, str(orders)), counted(spark, str(orders), "layer_row_counts")
    w = order_warehouse(spark, str(orders))
    if gone == "files":
        shutil.rmtree(w.location.removeprefix("file:"))
    else:
        for layer in ("bronze", "silver", "gold"):
            spark.sql(f"DROP DATABASE {w.schema(layer)} CASCADE")
    assert (counted(spark, str(orders)), counted(spark, str(orders), "layer_row_counts")) == before


def test_queries_after_files_have_gone_from_their_folders(spark, orders):
    before = counted(spark, str(orders)), counted(spark, str(orders), "layer_row_counts")
    w = order_warehouse(spark, str(orders))
    for folder, _, names in os.walk(w.location.removeprefix("file:")):
        for name in names:
            os.remove(f"{folder}/{name}")
    assert (counted(spark, str(orders)), counted(spark, str(orders), "layer_row_counts")) == before


def test_queries_after_the_order_tables_are_replaced(spark, orders):
    assert [r["results"] for r in counted(spark, str(orders))] == [5]
    write_orders(spark, orders, 8)
    assert [r["results"] for r in counted(spark, str(orders))] == [8]


def test_layers_of_drivers_with_one_application_id(orders, tmp_path):
    """Masters that start in the same second give the same id; one driver's end must not take the other's layers."""
    code = f"""
import subprocess, sys
import __spark_entry__ as contract
from stridebase.session import build_session
settings = {{"spark.test.appId": "local-1", "spark.checkpoint.dir": "{tmp_path}/shared", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"}}
spark = build_session("t", "local[2]", **settings)
assert spark.sparkContext.applicationId == "local-1"
counts = contract.queries()["country_counts"](spark, "{orders}")
if "other" not in sys.argv:
    subprocess.run([sys.executable, "-c", open(sys.argv[1]).read(), sys.argv[1], "other"], check=True, timeout=120)
assert [r["results"] for r in counts.collect()] == [5]
"""
    script = tmp_path / "driver.txt"
    script.write_text(code)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    ended = subprocess.run([sys.executable, "-c", code, str(script)], capture_output=True, text=True, timeout=240, cwd=root)
    assert ended.returncode == 0, ended.stderr[-2000:]


# Finding -> the query it names.
REPORTED = {
    "F3": "audit_gold",
    "F4": "audit_rejected_keys",
    "F5": "bronze_races_csv",
    "F6": "cleaning_report",
    "F7": "conversion_failures",
    "F8": "country_counts",
    "F9": "csv_files_set_aside",
    "F10": "csv_line_counts",
    "F11": "dash_gender_distribution",
    "F12": "dash_kpi_overview",
    "F13": "dash_participation_trend",
    "F14": "dash_speed_by_distance",
    "F15": "dash_top10_fastest",
    "F16": "dash_top_countries",
    "F17": "dense_ids_athlete",
    "F18": "dense_ids_athlete_first10",
    "F19": "dense_ids_event",
    "F20": "dense_ids_event_first10",
    "F21": "dense_ids_year",
    "F22": "describe_numeric",
}


@pytest.fixture(scope="module")
def many_orders(spark, tmp_path_factory):
    """Order tables of some hundred results, with athletes and parts of all kinds."""
    folder = tmp_path_factory.mktemp("orders")
    tables = {
        "customer": ([(k, k % 25, "BUILDING") for k in range(1, 121)], "c_custkey long, c_nationkey int, c_mktsegment string"),
        "part": ([(k, f"red {k}", "Brand#1", k) for k in range(1, 25)], "p_partkey long, p_name string, p_brand string, p_size int"),
        "orders": ([(k, k % 120 + 1) for k in range(1, 601)], "o_orderkey long, o_custkey long"),
        "lineitem": (
            [(k, 1, k % 24 + 1, datetime(1992 + k % 7, 1, 1)) for k in range(1, 601)],
            "l_orderkey long, l_linenumber int, l_partkey long, l_shipdate timestamp",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("query", REPORTED.values(), ids=REPORTED)
def test_reported_queries_with_the_directory_as_a_path(spark, many_orders, query):
    rows = counted(spark, many_orders, query)
    assert rows and sorted(map(str, rows)) == sorted(map(str, counted(spark, str(many_orders), query)))


def test_stored_tables_leave_no_shuffle_files(spark, tmp_path):
    """they stayed on disk until the driver's garbage was collected."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = disk.getAllFiles()
        names = (files.apply(i).getName() for i in range(files.size()))
        return {name for name in names if name.startswith("shuffle_")}

    create_schema(spark, "shuffled", f"{tmp_path}/db")
    before = shuffles()
    counts = spark.range(1000).groupBy(F.col("id") % 10).count()
    stored = refresh_table(counts, "shuffled.counts", "Counts", f"{tmp_path}/db/counts")
    until = time.time() + 20
    while (left := shuffles() - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and all(name.endswith(".zstd.parquet") for name in stored.inputFiles())
    assert stored.count() == 10
    spark.sql("DROP DATABASE shuffled CASCADE")
