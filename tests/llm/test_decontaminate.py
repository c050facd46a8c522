import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from stridebase.llm import decontaminate, words
from stridebase.llm.decontaminate import bands, find_contained, item_sets, size_classes, without_contaminated


def shingles(text):
    w = words._WORD.findall((text or "").lower())
    return [tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))] if w else []


def brute_force(docs, items, threshold=0.8):
    out = []
    for d, text in docs:
        sequence = shingles(text)
        n = len(words._WORD.findall((text or "").lower()))
        for i, item in items:
            wanted = set(shingles(item))
            shared = len(wanted & set(sequence))
            if wanted and shared >= threshold * len(wanted) - 1e-9:
                at = [k for k, s in enumerate(sequence) if s in wanted]
                out.append((d, i, shared, len(wanted), shared / len(wanted), at[0], at[-1] + min(5, n) - 1))
    return sorted(out, key=str)


def prose(seed, size):
    return [f"v{x}" for x in np.random.default_rng(seed).integers(0, 5000, size)]


def corpus():
    items = [(i, " ".join(prose(i, n))) for i, n in enumerate([15, 18, 30, 33, 59, 60, 200, 1000, 5, 4, 1])]
    items += [(20, None), (21, ""), (22, "..."), (22, items[0][1]), (None, items[2][1])]
    docs = []
    for k, (i, text) in enumerate(items[:11]):
        filler = prose(1000 + k, 20_000 if k % 2 else 300)
        w = text.split()
        docs.append((k, " ".join(filler[:150] + w + filler[150:])))
        cut = w[: int(len(w) * 0.87)]  # near the threshold
        docs.append((100 + k, " ".join(filler[:100] + cut + filler[100:])))
        docs.append((200 + k, " ".join(filler[:100] + w[: len(w) // 2] + filler[100:])))
        third = max(len(w) // 3, 1)  # in parts, far from each other
        docs.append((300 + k, " ".join(w[: 2 * third + 4] + filler + w[2 * third :])))
        docs.append((400 + k, text.upper()))
    docs += [(500, None), (501, ""), (502, "?"), (None, docs[0][1]), (0, docs[0][1]), (503, items[9][1])]
    return docs, items


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frames(spark, docs, items):
    extra = "item_id long, shared int"
    return (
        spark.createDataFrame([(*d, 1, 2) for d in docs], f"doc_id long, text string, {extra}"),
        spark.createDataFrame([(*i, 3) for i in items], "item_id long, text string, doc_id int"),
    )


def test_against_brute_force(spark):
    docs, items = corpus()
    assert rows(find_contained(*frames(spark, docs, items))) == brute_force(docs, items)


def test_blocks_of_a_large_benchmark(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 600)
    docs, items = corpus()
    assert rows(find_contained(*frames(spark, docs, items))) == brute_force(docs, items)


def test_documents_that_go(spark):
    docs, items = corpus()
    df, benchmark = frames(spark, docs, items)
    kept = without_contaminated(df, benchmark)
    dirty = {r[0] for r in brute_force(docs, items)}
    assert kept.columns == df.columns
    assert rows(kept.select("doc_id")) == sorted(((d,) for d, _ in docs if d not in dirty), key=str)


def test_empty_tables(spark):
    docs, items = frames(spark, *corpus())
    assert find_contained(docs.where("false"), items).collect() == []
    assert find_contained(docs, items.where("false")).collect() == []
    assert without_contaminated(docs, items.where("false")).count() == docs.count()


@given(st.integers(5, 64), st.integers(0, 10_000))
@settings(max_examples=60, deadline=None)
def test_windows_find_contiguous_items(size, seed):
    item = prose(seed, size + 4)
    filler = prose(seed + 1, 3000)
    at = seed % 2900
    text = " ".join(filler[:at] + item + filler[at:])
    sets = item_sets([" ".join(item)])
    assert decontaminate.contained([None, text], sets, size_classes(sets, 0.8), 0.8)[0][:2] == (1, 0)


def test_bands_reach_the_recall():
    for least, upper in ((33, 64), (17, 32), (1, 4)):
        jaccard = 0.8 * least / (2 * upper + 0.2 * least)
        assert 1 - (1 - jaccard) ** bands(least, upper, 0.8) >= decontaminate.RECALL


def test_rows_that_repeat_an_id_go_by_their_own_text(spark):
    _, items = corpus()
    dirty, clean = items[0][1], " ".join(prose(77, 40))
    docs = [(1, dirty), (1, clean), (2, clean), (None, dirty), (None, clean), (3, None)]
    kept = without_contaminated(*frames(spark, docs, items))
    assert rows(kept.select("doc_id", "text")) == sorted([d for d in docs if d[1] != dirty], key=str)
