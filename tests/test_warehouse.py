"""Stored layers, CSV source, invariants between the layers, and the streamed refresh."""

import os
import shutil
import subprocess
import sys
import uuid

import pytest
from pyspark.sql import functions as F

from stridebase.plans import quality
from stridebase.plans.silver import EUROPE, SILVER_COLUMNS, clean_results
from stridebase.plans.warehouse import GOLD_TABLES, StreamedWarehouse, Warehouse
from stridebase.schema import BRONZE_SCHEMA, RAW_COLUMNS
from stridebase.session import shared_folder
from stridebase.sources.races_csv import count_lines, read_races_csv, rejected_lines, write_races_csv
from stridebase.sources.tables import create_schema, cut_lineage, intermediates, refresh_table
from stridebase.streaming.incremental import refresh_silver, stream_races
from tests.compare import open_duckdb
from tests.conftest import SF_DIR


def same_rows(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def raw_row(**values):
    defaults = {
        "year_of_event": 2001,
        "event_dates": "01.01.2001",
        "event_name": "Test 50",
        "event_distance_length": "50km",
        "event_number_of_finishers": 10,
        "athlete_performance": "4:51:39 h",
        "athlete_club": None,
        "athlete_country": "SWE",
        "athlete_year_of_birth": 1978.0,
        "athlete_gender": "M",
        "athlete_age_category": "M23",
        "athlete_average_speed": "10.2 km/h",
        "athlete_id": 1,
    }
    return tuple({**defaults, **values}[name] for name in BRONZE_SCHEMA.names)


def raw(spark, *rows):
    return spark.createDataFrame([raw_row(**row) for row in rows], BRONZE_SCHEMA)


def test_clean_row(spark):
    row = clean_results(raw(spark, {"athlete_country": " swe ", "athlete_gender": " w"})).first()
    assert row.performance_seconds == 17499
    assert (row.athlete_country, row.athlete_gender, row.athlete_age_at_event) == ("SWE", "W", 23)
    assert row.athlete_average_speed == pytest.approx(10.2)


@pytest.mark.parametrize(
    "dirty",
    [
        {"event_distance_length": None},
        {"event_distance_length": "50mi"},
        {"event_distance_length": "24h", "athlete_performance": "120.5"},
        {"athlete_country": "USA"},
        {"athlete_country": None},
        {"athlete_id": None},
        {"athlete_performance": None},
        {"athlete_performance": "120.5"},
        {"athlete_performance": "1d 05:00:00 h"},
        {"athlete_performance": "0:00:00 h"},
        {"athlete_performance": "999999:00:00"},
        {"athlete_average_speed": None},
        {"athlete_average_speed": "4:03:00"},
        {"athlete_average_speed": "0.4 km/h"},
        {"athlete_average_speed": "35.1 km/h"},
        {"athlete_average_speed": "n/a"},
        {"athlete_average_speed": "1.2.3"},
    ],
)
def test_dropped_row(spark, dirty):
    assert clean_results(raw(spark, dirty)).isEmpty()


def test_limits_are_inclusive_and_parameters(spark):
    rows = raw(spark, *[{"athlete_average_speed": f"{s} km/h"} for s in ("0.5", "35", "29.9")])
    assert clean_results(rows).count() == 3
    assert clean_results(rows, low=1, high=30).count() == 1
    assert clean_results(raw(spark, {"athlete_country": "GER"}), countries=["GER"]).count() == 1


def test_layers_fit_together(warehouse):
    silver, fct = warehouse.silver, warehouse.fct_results
    assert silver.columns == SILVER_COLUMNS
    assert silver.count() == fct.count() == 2734
    assert (warehouse.dim_athlete.count(), warehouse.dim_event.count()) == (120, 132)
    orphans = quality.foreign_key_orphans(warehouse.star).collect()
    assert [(r.orphan_keys, r.orphan_results) for r in orphans] == [(0, 0)] * 3
    assert silver.where("performance_seconds <= 0 OR performance_seconds IS NULL").isEmpty()
    assert silver.where(~F.col("athlete_country").isin(*EUROPE)).isEmpty()
    assert silver.where(~F.lower(F.trim("event_distance_length")).endswith("km")).isEmpty()


def test_partitioning_of_the_input_does_not_matter(warehouse):
    spread = warehouse.races.repartition(13, "athlete_performance")
    assert same_rows(clean_results(spread), warehouse.silver)


def test_refresh_is_repeatable_and_documented(spark, warehouse, shared):
    prefix = "t" + uuid.uuid4().hex[:8] + "_"
    other = Warehouse(warehouse.races, f"{shared}/{prefix}", prefix)
    first = {name: df.collect() for name, df in other.refresh().items()}
    second = {name: df.collect() for name, df in other.refresh().items()}
    order = lambda rows: sorted(rows, key=repr)
    assert {n: order(r) for n, r in first.items()} == {n: order(r) for n, r in second.items()}
    tables = {t.name: t.description for t in spark.catalog.listTables(other.schema("gold"))}
    assert set(tables) == set(GOLD_TABLES) and all(tables.values())
    other.drop()
    assert spark.catalog.listTables(other.schema("gold")) == []
    # As in a new application: the files are there, the catalog does not know them.
    again = {name: df.collect() for name, df in other.refresh().items()}
    assert {n: order(r) for n, r in again.items()} == {n: order(r) for n, r in first.items()}


def test_documented_types(warehouse):
    types = {name: dict(df.dtypes) for name, df in warehouse.gold().items()}
    assert types["mart_fastest_athletes"]["performance_hours"] == "decimal(14,2)"
    assert types["mart_top_countries"] == {
        "athlete_country": "string",
        "total_finishers": "bigint",
        "avg_speed_kmh": "double",
        "avg_time_hours": "double",
    }
    assert types["fct_results"]["athlete_average_speed"] == "float"


def test_partitioned_table(spark, warehouse, shared):
    schema = "t" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{shared}/{schema}'")
    stored = refresh_table(warehouse.silver, f"{schema}.obt", "It's by year", f"{shared}/{schema}/obt", ("year_of_event",))
    assert same_rows(stored.select(*SILVER_COLUMNS), warehouse.silver)
    stored = refresh_table(warehouse.silver, f"{schema}.obt", "Again", f"{shared}/{schema}/obt", ("year_of_event",))
    assert same_rows(stored.select(*SILVER_COLUMNS), warehouse.silver)
    one_year = stored.where("year_of_event = 1998")
    assert "PartitionFilters: [isnotnull(year_of_event" in plan(one_year)


def plan(df):
    return df._jdf.queryExecution().toString()


def test_csv_round_trip(spark, warehouse, shared):
    path = f"{shared}/{uuid.uuid4().hex}"
    write_races_csv(warehouse.races, path)
    back = read_races_csv(spark, path)
    assert back.schema == BRONZE_SCHEMA
    assert same_rows(back, warehouse.races)


def test_csv_of_clean_times_stays_text(spark, shared):
    path = f"{shared}/{uuid.uuid4().hex}"
    write_races_csv(raw(spark, {"athlete_performance": "4:51:39"}, {"athlete_performance": "5:00:00"}), path)
    assert {r.athlete_performance for r in read_races_csv(spark, path).collect()} == {"4:51:39", "5:00:00"}


def test_csv_with_other_headers_fails(spark, shared):
    path = f"{shared}/{uuid.uuid4().hex}"
    headers = [header for header, _, _ in RAW_COLUMNS]
    headers[0], headers[2] = headers[2], headers[0]
    spark.createDataFrame([("x",) * 13], headers).write.option("header", True).csv(path)
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_races_csv(spark, path).collect()


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_streamed_refresh_equals_batch(spark, warehouse, shared, file_format):
    base = f"{shared}/{uuid.uuid4().hex}"
    halves = warehouse.races.randomSplit([0.5, 0.5], seed=3)
    incoming, target, checkpoint = f"{base}/incoming", f"{base}/obt", f"{base}/checkpoint"

    def arrive(rows, label):
        staged = f"{base}/{label}"
        if file_format == "csv":
            write_races_csv(rows.coalesce(3), staged)
        else:
            rows.coalesce(3).write.parquet(staged)
        shutil.copytree(staged, incoming, dirs_exist_ok=True, ignore=shutil.ignore_patterns("_*", ".*"))

    def refresh():
        query = refresh_silver(stream_races(spark, incoming, file_format, files_per_batch=2), target, checkpoint)
        query.awaitTermination()
        return spark.read.parquet(target)

    arrive(halves[0], "first")
    assert refresh().count() == clean_results(halves[0]).count()
    arrive(halves[1], "second")
    assert same_rows(refresh(), warehouse.silver)
    assert same_rows(refresh(), warehouse.silver)  # nothing new: nothing added


def test_stream_then_full_refresh_then_stream(spark, warehouse, shared):
    """Every file of the landing folder is cleaned once, whatever is refreshed in full beside it."""
    base = f"{shared}/{uuid.uuid4().hex}"
    warehouse.races.write.parquet(f"{base}/landing")
    prefix = "t" + uuid.uuid4().hex[:8] + "_"
    streamed = StreamedWarehouse(spark, f"{base}/landing", f"{base}/streamed", prefix)
    full = Warehouse(spark.read.parquet(f"{base}/landing"), f"{base}/full", f"{prefix}full_")
    assert same_rows(streamed.silver, warehouse.silver)
    full.refresh()
    streamed.refresh()
    full.refresh()
    streamed.refresh()
    assert same_rows(streamed.silver, warehouse.silver)
    for name in GOLD_TABLES:
        assert same_rows(getattr(streamed, name), getattr(full, name))
    for folder in (f"{base}/full/bronze/races", f"{base}/full/bronze/races/" + versions(f"{base}/full/bronze/races")[-1]):
        with pytest.raises(ValueError, match="refreshed in full"):
            stream_races(spark, folder)


def test_limits_of_a_streamed_refresh(spark, shared):
    base = f"{shared}/{uuid.uuid4().hex}"
    rows = raw(spark, *[{"athlete_average_speed": f"{s} km/h"} for s in ("0.5", "35", "29.9")])
    write_races_csv(rows, f"{base}/landing")
    prefix = "t" + uuid.uuid4().hex[:8] + "_"
    strict = StreamedWarehouse(spark, f"{base}/landing", f"{base}/layers", prefix, "csv", low=1, high=30)
    assert [round(r["athlete_average_speed"], 1) for r in strict.silver.collect()] == [29.9]
    assert strict.fct_results.count() == 1
    strict.drop()
    assert files_under(f"{base}/layers") == 0


def versions(folder):
    return sorted(name for name in os.listdir(folder) if name.startswith("v"))


def files_under(folder):
    return sum(len(names) for _, _, names in os.walk(folder))


def test_failed_refresh_leaves_the_table(spark, shared):
    schema = "t" + uuid.uuid4().hex[:8]
    path = f"{shared}/{schema}/numbers"
    create_schema(spark, schema, f"{shared}/{schema}")
    name = f"{schema}.numbers"
    stored = refresh_table(spark.range(10), name, "It's \\ a comment", path)
    before = files_under(path)
    with pytest.raises(Exception, match="broken"):
        refresh_table(spark.range(5).select(F.raise_error(F.lit("broken")).cast("long").alias("id")), name, "", path)
    assert spark.table(name).count() == stored.count() == 10
    assert files_under(path) == before
    assert spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Comment'").first()["data_type"] == "It's \\ a comment"
    # readers that began before a refresh still find their files after it
    assert refresh_table(spark.range(3), name, "", path).count() == 3
    assert stored.count() in (3, 10)
    assert refresh_table(spark.range(2).select("id", F.lit(1).alias("more")), name, "", path).columns == ["id", "more"]


def test_paths_and_comments_are_quoted(spark, shared):
    schema = "t" + uuid.uuid4().hex[:8]
    folder = f"{shared}/it's {schema}"
    create_schema(spark, schema, folder)
    assert refresh_table(spark.range(4), f"{schema}.t", "a 'b' \\c", f"{folder}/t").count() == 4


def test_files_of_repeated_refreshes_are_bounded_and_dropped(spark, warehouse, shared):
    prefix = "t" + uuid.uuid4().hex[:8] + "_"
    other = Warehouse(warehouse.races, f"{shared}/{prefix}", prefix)
    counts = []
    for _ in range(3):
        other.refresh()
        counts.append(files_under(f"{shared}/{prefix}"))
    assert counts[2] == counts[1] < 3 * counts[0]
    other.explore_v1
    other.drop()
    assert files_under(f"{shared}/{prefix}") == 0


def test_intermediate_tables_go_with_their_run(spark):
    with intermediates(spark) as folder:
        kept = cut_lineage(spark.range(7), "numbers")
        assert kept.count() == 7 and files_under(folder) > 0
    assert not os.path.exists(folder)
    assert cut_lineage(spark.range(7), "numbers").count() == 7  # outside a run: until the application ends


def test_applications_remove_their_folder(tmp_path):
    code = f"""
from stridebase.session import build_session
from stridebase.sources.tables import cut_lineage
spark = build_session("t", "local[1]", **{{"spark.checkpoint.dir": "{tmp_path}/shared", "spark.ui.enabled": "false"}})
assert cut_lineage(spark.range(7), "numbers").count() == 7
import os
assert os.listdir("{tmp_path}/shared/stridebase")
"""
    subprocess.run([sys.executable, "-c", code], check=True, capture_output=True, timeout=120, cwd=os.path.dirname(os.path.dirname(__file__)))
    assert os.listdir(f"{tmp_path}/shared/stridebase") == []


class Session:
    """What :func:`shared_folder` asks of a session."""

    def __init__(self, spark, master, **settings):
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: settings.get(key.replace(".", "_"), default))})
        self.sparkContext = type("Context", (), {"master": master, "applicationId": uuid.uuid4().hex})
        self._jvm, self._jsc = spark._jvm, spark._jsc


def test_shared_folder(spark):
    local = Session(spark, "local[2]")
    assert shared_folder(local) == shared_folder(local) and os.path.isdir(shared_folder(local))
    assert shared_folder(Session(spark, "local[2]", spark_checkpoint_dir="/some/folder/")) == "/some/folder"
    for settings in ({}, {"spark_checkpoint_dir": "/plain"}, {"spark_checkpoint_dir": "file:/disk"}):
        with pytest.raises(RuntimeError):
            shared_folder(Session(spark, "spark://host:7077", **settings))
    mounted = Session(spark, "yarn", spark_checkpoint_dir="file:/mnt/all", spark_stridebase_sharedMount="true")
    assert shared_folder(mounted) == "file:/mnt/all"


def test_malformed_lines_are_counted(spark, shared):
    path = f"{shared}/{uuid.uuid4().hex}"
    write_races_csv(raw(spark, {"event_name": 'Quoted, with "comma"'}, {"athlete_id": 2}).coalesce(1), path)
    (name,) = [n for n in os.listdir(path) if n.endswith(".csv")]
    with open(f"{path}/{name}") as lines:
        header, quoted, good = lines.read().splitlines()
    with open(f"{path}/{name}", "w") as out:
        short = ",".join(good.split(",")[:4])
        bad = good.rpartition(",")[0] + ",12x"
        out.write("\n".join([header, quoted, good, short, bad]) + "\n")
    os.remove(f"{path}/.{name}.crc")
    rows = read_races_csv(spark, path).collect()
    assert len(rows) == 4 and sum(r["athlete_id"] is None for r in rows) == 2
    assert {r["event_name"] for r in rows} == {'Quoted, with "comma"', "Test 50"}
    assert sorted(r["rejected_line"] for r in rejected_lines(spark, path).collect()) == sorted([short, bad])
    assert count_lines(spark, path).first()[:2] == (4, 2)
    with pytest.raises(Exception, match="(?i)malformed"):
        read_races_csv(spark, path, fail=True).collect()


def test_fixture_sizes():
    with open_duckdb(SF_DIR) as con:
        assert con.execute("SELECT count(*) FROM lineitem").fetchone() == (6000,)
