"""Registered queries of the package: against DuckDB where SQL can express them, and their shapes."""

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from stridebase.llm import queries
from tests.compare import differences, open_duckdb
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def duck():
    with open_duckdb(SF_DIR) as con:
        yield con


def test_one_query_per_operator_and_the_pipeline():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", queries.SQL)
def test_against_sql(spark, duck, name):
    assert differences(queries.QUERIES[name](spark, SF_DIR), duck, queries.SQL[name]) == []


SHAPES = {
    "op1_chat": "conv_id bigint, turn bigint, role string, content string, rendered string, lines bigint, held_out boolean",
    "op3_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op4_url_filter": "page_id bigint, host string, path string, rule string, verdict string, template string, bad_share double",
    "op5_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op9_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op10_licenses": "doc_id bigint, first_line int, last_line int, license string, gain double, missing string, added string, block string",
    "op11_alignment": "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string",
    "op12_whitening": "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double",
    "op13_html_text": "page_id bigint, url string, text string, n_chars bigint",
}


@pytest.mark.parametrize("name", SHAPES)
def test_columns(spark, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    assert [f"{n} {t}" for n, t in df.dtypes] == SHAPES[name].split(", ")


def test_pipeline_stages_agree_with_their_operators(spark):
    from stridebase.llm import decontaminate, neighbours, ngram_join
    from stridebase.llm.tables import cut_lineage, table

    docs = table(spark, SF_DIR, "documents")
    kept = [cut_lineage(docs, "docs")]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(cut_lineage(stage(spark, kept[-1], SF_DIR), "stage"))
        assert kept[-1].columns == docs.columns
        assert kept[-1].exceptAll(kept[-2]).count() == 0  # rows are kept or dropped, never changed
    ids = [{r[0] for r in df.select("doc_id").collect()} for df in kept]

    voters = neighbours.fit_voters(docs, table(spark, SF_DIR, "labels"))
    scores = {r["doc_id"]: r["score"] for r in neighbours.quality_scores(docs, voters, keep=["doc_id"]).collect()}
    assert ids[1] == {i for i, s in scores.items() if s >= neighbours.ACCEPTED}
    classes = {r["doc_id"]: r["class_id"] for r in ngram_join.similar_documents(kept[1]).collect()}
    assert ids[2] == set(classes.values()) and len(ids[2]) < len(ids[1])
    found = decontaminate.find_contained(kept[2], table(spark, SF_DIR, "benchmark"))
    assert ids[3] == ids[2] - {r["doc_id"] for r in found.collect()}
    packed = corpus_pipeline.STAGES[-1][1](spark, kept[3], SF_DIR)
    assert {r[0] for r in packed.select("doc_id").distinct().collect()} == ids[3]


def test_run_is_the_stages(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0
    assert corpus_pipeline.ORACLE_SQL is None
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing",
    ]
