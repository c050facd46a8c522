"""Audits in front of publication: what passes, what is kept back, and what it costs."""

import uuid

import pytest
from pyspark.sql import functions as F

from stridebase.plans import quality
from stridebase.plans.star_queries import Star
from stridebase.plans.warehouse import Warehouse
from stridebase.sources.audit import AuditFailed, Rules, as_table, publish
from stridebase.sources.tables import create_schema
from tests.test_warehouse import files_under


@pytest.fixture
def place(spark, shared):
    schema = "t" + uuid.uuid4().hex[:8]
    create_schema(spark, schema, f"{shared}/{schema}")
    return f"{schema}.numbers", f"{shared}/{schema}/numbers"


def test_a_table_that_keeps_its_rules(spark, place):
    name, path = place
    df = spark.range(10).select("id", (F.col("id") % 3).alias("third"))
    stored, findings = publish(df, name, "Numbers", path, Rules("id", required=("id",), references={"third": spark.range(3).toDF("t")}))
    assert stored.count() == 10 and all(f.passed and f.checked_rows == 10 and f.broken_rows == 0 for f in findings)
    assert [(f.rule, f.column_name) for f in findings] == [("required", "id"), ("unique", "id"), ("reference", "third")]
    assert as_table(spark, findings).count() == 3


def test_a_broken_version_is_never_published(spark, place):
    name, path = place
    publish(spark.range(5), name, "Numbers", path, Rules("id"))
    files = files_under(path)
    bad = spark.createDataFrame([(1, 7), (1, 7), (2, None), (3, 8), (None, 9)], "id long, other int")
    rules = Rules("id", required=("id", "other"), references={"other": spark.createDataFrame([(7,)], "x int")})
    with pytest.raises(AuditFailed, match="was not published") as failed:
        publish(bad, name, "Bad", path, rules)
    assert sorted(r["id"] for r in spark.table(name).collect()) == [0, 1, 2, 3, 4]
    assert files_under(path) == files
    found = {(f.rule, f.column_name): (f.broken_keys, f.broken_rows, f.passed) for f in failed.value.findings}
    assert found == {
        ("required", "id"): (1, 1, False), ("required", "other"): (1, 1, False), ("unique", "id"): (1, 2, False), ("reference", "other"): (2, 2, False),
    }
    keys = sorted(map(tuple, failed.value.violations.collect()), key=str)
    assert keys == sorted(
        [("required", "id", None, 1), ("required", "other", None, 1), ("unique", "id", "1", 2), ("reference", "other", "8", 1), ("reference", "other", "9", 1)], key=str
    )


def test_reported_keys_do_not_stop_a_table(spark, place):
    name, path = place
    df = spark.createDataFrame([(1,), (1,), (2,)], "id long")
    stored, (finding,) = publish(df, name, "", path, Rules("id", unique=False))
    assert stored.count() == 3 and finding.passed and (finding.broken_keys, finding.broken_rows) == (1, 2)


def test_empty_and_partitioned_tables(spark, place):
    name, path = place
    _, findings = publish(spark.range(0), name, "", path, Rules("id", required=("id",)))
    assert [f.checked_rows for f in findings] == [0, 0]
    df = spark.range(100).select("id", (F.col("id") % 4).alias("part"))
    stored, findings = publish(df, name, "", path, Rules("id", required=("id", "part")), ("part",))
    assert stored.count() == 100 and all(f.checked_rows == 100 for f in findings)


def test_the_write_counts_rows_and_missing_values(spark, place):
    """The rows are computed once: by the write."""
    name, path = place
    computed = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            computed.add(len(batch))
            yield batch

    df = spark.range(1000).mapInPandas(count, "id long")
    publish(df, name, "", path, Rules("id", required=("id",)))
    assert computed.value == 1000


def test_audited_layers(spark, warehouse, shared):
    prefix = "t" + uuid.uuid4().hex[:8] + "_"
    layers = Warehouse(warehouse.races, f"{shared}/{prefix}", prefix, audited=True)
    layers.refresh()
    assert set(layers.findings) == set(quality.PRIMARY_KEYS)
    assert all(f.passed for findings in layers.findings.values() for f in findings)
    assert sum(f.broken_rows for f in layers.findings["fct_results"] if f.rule == "unique") > 0  # reported
    # a fact whose athletes are missing stays out, and the old one stays readable
    before = layers.fct_results.count()
    layers.__dict__["dim_athlete"] = layers.dim_athlete.limit(3)
    del layers.__dict__["fct_results"]
    with pytest.raises(AuditFailed) as failed:
        layers.fct_results
    assert spark.table(f"{layers.schema('gold')}.fct_results").count() == before
    orphans = quality.foreign_key_orphans(Star(warehouse.fct_results, layers.dim_athlete, warehouse.dim_event, warehouse.dim_time))
    (expected,) = orphans.where("dimension = 'dim_athlete'").collect()
    violations = failed.value.violations.where("rule = 'reference'")
    assert violations.count() == expected["orphan_keys"] and violations.agg(F.sum("rows")).first()[0] == expected["orphan_results"]
    layers.drop()
