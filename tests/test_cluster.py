"""Queries on a cluster whose shared folder is a plain one that all machines mount."""

import json
from datetime import datetime

import pytest

import __spark_entry__ as contract
from stridebase.sources import tables
from tests.cluster import run_on_cluster

# Finding -> the query it names.
REPORTED = {
    "F1": "pipeline",
    "F2": "op1_chat",
    "F3": "op2_warc",
    "F4": "op3_sharding",
    "F5": "op4_url_filter",
    "F6": "op6_exact_topk",
    "F7": "op7_ngram_join",
    "F8": "op9_packing",
    "F9": "op11_alignment",
    "F10": "age_distribution",
    "F11": "age_distribution_bronze",
    "F12": "audit_gold",
    "F13": "audit_rejected_keys",
    "F14": "cleaning_report",
    "F15": "bronze_races_csv",
    "F16": "conversion_failures",
    "F17": "country_counts",
    "F18": "csv_files_set_aside",
    "F19": "dash_gender_distribution",
    "F20": "csv_line_counts",
    "F21": "dash_kpi_overview",
    "F22": "dash_participation_trend",
    "F23": "dash_speed_by_distance",
    "F24": "dash_top_countries",
    "F25": "dash_top10_fastest",
    "F26": "dense_ids_athlete_first10",
    "F27": "dense_ids_athlete",
    "F28": "dense_ids_event",
    "F29": "dense_ids_event_first10",
    "F30": "dense_ids_year",
    "F31": "dim_athlete",
    "F32": "describe_numeric",
    "F33": "dim_athlete_incremental",
}

GOOD = "the quick brown fox number {0} jumps over a lazy dog near river {0} while clouds of kind {0} drift past hill {0}"
ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"

RUN = """
import json
import __spark_entry__ as contract
from tests.test_cluster import plain
found = {{}}
for name in {names!r}:
    try:
        found[name] = plain(contract.queries()[name](spark, {tables!r}))
    except Exception as error:
        found[name] = f"{{type(error).__name__}}: {{error}}"
with open({answers!r}, "w") as out:
    json.dump(found, out)
"""

ASK = """
from stridebase.sources.tables import application_folder, cut_lineage
try:
    print(application_folder(spark), cut_lineage(spark.range(0, 50, 1, 6), "numbers").count())
except RuntimeError as error:
    print("refused:", error)
"""


def plain(df):
    """The rows as sorted text, numbers to six digits."""
    return sorted(str([f"{v:.6g}" if isinstance(v, float) else str(v) for v in row]) for row in df.collect())


@pytest.fixture(scope="module")
def small_tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    docs = [(i, GOOD.format(i)) for i in range(30)] + [(100 + i, "### $$$ !!! ### %%% $$$ " * 20) for i in range(10)]
    docs += [(200, GOOD.format(3)), (201, GOOD.format(3).upper()), (300, f"{GOOD.format(300)} {ITEM}"), (301, None), (302, "")]
    talk = [(c, t, ("user", "assistant")[t % 2], f"Is it {GOOD.format(7 * c + t)}?") for c in range(12) for t in range(4)]
    pages = [(i, f"http://h{i % 3}.example.org/en/{i}/x{i % 5}.html", f"<html><body><p>{GOOD.format(i % 20)}</p></body></html>") for i in range(40)]
    rows = {
        "customer": ([(k, k % 25, "BUILDING") for k in range(1, 121)], "c_custkey long, c_nationkey int, c_mktsegment string"),
        "part": ([(k, f"red {k}", "Brand#1", k) for k in range(1, 25)], "p_partkey long, p_name string, p_brand string, p_size int"),
        "orders": ([(k, k % 120 + 1) for k in range(1, 601)], "o_orderkey long, o_custkey long"),
        "lineitem": (
            [(k, 1, k % 24 + 1, datetime(1992 + k % 7, 1, 1)) for k in range(1, 601)],
            "l_orderkey long, l_linenumber int, l_partkey long, l_shipdate timestamp",
        ),
        "documents": ([(*d, "en", "web", 1) for d in docs], "doc_id long, text string, lang string, source string, n_chars long"),
        "labels": ([(i, 1, 0) for i in range(30)] + [(100 + i, 0, 0) for i in range(10)], "doc_id long, quality int, toxic int"),
        "benchmark": ([(1, ITEM)], "item_id long, text string"),
        "pages": (pages, "page_id long, url string, html string"),
        "conversations": (talk, "conv_id long, turn long, role string, text string"),
        "embeddings": ([(i, [((i * k) % 17) / 17 for k in range(1, 9)]) for i in range(120)], "vec_id long, embedding array<float>"),
    }
    for name, (table, schema) in rows.items():
        spark.createDataFrame(table, schema).coalesce(2).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def answers(small_tables, tmp_path_factory):
    """What the reported queries return there, from one application."""
    place = tmp_path_factory.mktemp("cluster")
    code = RUN.format(names=[*REPORTED.values()], tables=small_tables, answers=f"{place}/answers")
    ended = run_on_cluster(place, code, 900, spark_checkpoint_dir=f"file://{place}/shared")
    assert ended.returncode == 0, ended.stderr[-2000:]
    with open(f"{place}/answers") as found:
        return json.load(found)


@pytest.mark.parametrize("query", REPORTED.values(), ids=REPORTED)
def test_reported_queries_with_a_mounted_folder(answers, query):
    assert isinstance(answers[query], list) and answers[query]


@pytest.mark.parametrize("query", ["op3_sharding", "country_counts"])
def test_rows_with_a_mounted_folder(spark, small_tables, answers, query):
    assert answers[query] == plain(contract.queries()[query](spark, small_tables))


def test_folders_that_each_process_has_for_itself(tmp_path):
    own = {"spark_checkpoint_dir": "file:///proc/self/cwd/own", "spark_sql_warehouse_dir": "file:///proc/self/cwd/tables"}
    ended = run_on_cluster(tmp_path, ASK, 200, **own)
    assert ended.stdout.startswith("refused:"), ended.stdout + ended.stderr[-2000:]


def test_warehouse_if_the_named_folder_is_not_shared(tmp_path):
    folders = {"spark_checkpoint_dir": "file:///proc/self/cwd/own", "spark_sql_warehouse_dir": f"file://{tmp_path}/tables"}
    ended = run_on_cluster(tmp_path, ASK, 200, **folders)
    folder, count = ended.stdout.split()
    assert folder.startswith(f"file:{tmp_path}/tables/stridebase/") or folder.startswith(f"file://{tmp_path}/tables/stridebase/")
    assert count == "50"


def test_executors_that_join_without_the_folder(spark, monkeypatch):
    tables.application_folder(spark)
    monkeypatch.setattr(tables, "shared_folder", lambda spark: "/another/folder")
    with pytest.raises(RuntimeError):
        tables.cut_lineage(spark.range(7), "numbers")
