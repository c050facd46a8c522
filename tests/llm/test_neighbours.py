import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stridebase.llm import neighbours
from stridebase.llm.neighbours import fit, fit_voters, held_out, quality_scores, term_counts
from stridebase.llm.tables import table
from tests.conftest import SF_DIR

SF = SF_DIR.replace("sf0.001", "sf0.01")


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    voters = fit_voters(docs, labels)
    rows = quality_scores(docs, voters, keep=["doc_id"]).join(labels, "doc_id", "left").collect()
    return voters, rows


def test_held_out_accuracy(scored):
    held = [r for r in scored[1] if r["quality"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    right = [(r["score"] >= neighbours.ACCEPTED) == bool(r["quality"]) for r in held]
    assert len(held) > 50 and np.mean(right) >= 0.97
    good, bad = ([r["score"] for r in held if r["quality"] == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.98  # area under the curve


def test_scores_agree_with_brute_force(spark, scored):
    voters, rows = scored
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").limit(40).collect()}
    scores = {r["doc_id"]: r["score"] for r in rows}
    for doc, text in texts.items():
        own = voters.latent([term_counts(text)])[0]
        cosines = sorted(((float(v @ own), y) for v, y in zip(voters.vectors, voters.labels)), reverse=True)[: neighbours.NEIGHBOURS]
        weights = [np.exp(neighbours.SHARPNESS * (c - 1)) for c, _ in cosines]
        top = sum(w * y for w, (_, y) in zip(weights, cosines)) + neighbours.DOUBT * voters.prior
        assert scores[doc] == pytest.approx(top / (sum(weights) + neighbours.DOUBT), abs=1e-3)


@pytest.mark.parametrize("seed", range(3))
def test_scores_do_not_depend_on_the_block(seed):
    """600 voters of 77 different texts with mixed labels: ties at the last place."""
    rng = np.random.default_rng(seed)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 60, 20)) for _ in range(77)]
    voters = fit([term_counts(texts[i % 77]) for i in range(600)], rng.integers(0, 2, 600).astype(float))
    counts = [term_counts(" ".join(f"w{x}" for x in rng.integers(0, 60, 15))) for _ in range(256)]
    counts[7] = counts[100] = counts[255]
    whole = voters.scores(counts)
    assert whole[7] == whole[100] == whole[255]
    for size in (1, 7, 64):
        parts = np.concatenate([voters.scores(counts[i : i + size]) for i in range(0, 256, size)])
        assert (parts == whole).all()


def test_all_that_tie_with_the_last_vote():
    same = term_counts("one text that all voters share")
    voters = fit([same] * 40, np.array([1.0] * 10 + [0.0] * 30))
    share = voters.scores([same])[0]
    assert share == pytest.approx((10 + neighbours.DOUBT * voters.prior) / (40 + neighbours.DOUBT), abs=1e-4)


def test_only_the_learning_folds_teach(spark):
    docs = spark.createDataFrame([(i, f"text {i} " + "word " * i) for i in range(60)], "doc_id long, text string")
    right = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    held = held_out()
    wrong = right.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (fit_voters(docs, labels) for labels in (right, wrong))
    assert (a.vectors == b.vectors).all() and (a.labels == b.labels).all()
    count = sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(60))
    assert len(a.labels) == count
    assert len(fit_voters(docs, right, sample=7).labels) == 7


def test_nulls_repetitions_and_clashing_columns(spark):
    docs = [(1, "good text here", 0.5), (1, "good text here", 0.5), (2, None, None), (3, "", 1.0), (None, "!!! ### !!!", 2.0), (4, "é" * 300_000, 3.0)]
    frame = spark.createDataFrame([(*d, "t") for d in docs], "doc_id long, text string, score double, _text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (3, 7), (4, 0)], "doc_id long, quality int")
    voters = fit_voters(frame, labels)
    got = quality_scores(frame, voters)
    assert got.columns == ["doc_id", "text", "_text", "score"]
    rows = got.collect()
    assert len(rows) == len(docs) and all(0 <= r["score"] <= 1 and r["_text"] == "t" for r in rows)
    assert len({r["score"] for r in rows if r["text"] == "good text here"}) == 1
    assert {r["score"] for r in rows if not r["text"]} == {voters.prior}


def test_nothing_to_learn_from_and_nothing_to_score(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    voters = fit_voters(docs, labels)
    assert [r["score"] for r in quality_scores(docs, voters).collect()] == [0.5, 0.5]
    assert quality_scores(docs.where("false"), voters).collect() == []


def test_one_and_two_voters():
    for texts, labels in ((["a b c"], [1.0]), (["a b c", "!!! ###"], [1.0, 0.0])):
        voters = fit([term_counts(t) for t in texts], np.array(labels))
        scores = voters.scores([term_counts(t) for t in texts])
        assert [s > 0.5 for s in scores] == [bool(y) for y in labels]


def test_repetition_is_a_term():
    terms, values = term_counts("no no no no yes")
    assert terms[-1] == neighbours.TERMS - 1 and values[-1] == pytest.approx(0.75)
    assert term_counts("x")[1][-1] == 0
    assert len(term_counts(None)[0]) == len(term_counts("")[0]) == 0
