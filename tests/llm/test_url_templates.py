import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stridebase.llm import url_templates
from stridebase.llm.queries import URL_RULES
from stridebase.llm.url_templates import best_rule, host_of, judge_urls, kind_of, path_of, segments_of

URLS = [
    ("https://WWW.Ex.net/en/1?x#y", "www.ex.net", "/en/1"),
    ("http://a.b", "a.b", ""),
    ("http://a.b?q://c/d", "a.b", ""),
    ("http://a.b#f/g", "a.b", ""),
    ("x://ÄB/Ü", "Äb", "/Ü"),
    ("://h/p", "h", "/p"),
    ("no scheme", "", ""),
    ("", "", ""),
    (None, "", ""),
    ("http:///only/path", "", "/only/path"),
    ("http://h/a\nb", "h", "/a\nb"),
]


def test_host_and_path(spark):
    frame = spark.createDataFrame([(u,) for u, _, _ in URLS], "u string")
    got = frame.select(F.coalesce(host_of(F.col("u")), F.lit("")), F.coalesce(path_of(F.col("u")), F.lit(""))).collect()
    assert [tuple(r) for r in got] == [(h, p) for _, h, p in URLS]


def rule_of(host, path):
    """Brute force over the rules."""
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return (best.name, best.verdict) if best else (None, None)


def test_rules(spark):
    hosts = ["net", "example.net", "m.example.net", "badexample.net", "xnet", "example.com", "a.example.com", "x.org", "org", "", "example.net.de"]
    cases = [(h, p) for h in hosts for p in ("", "/", "/en", "/en/", "/en/1", "/de/2", "/fr/", "/x/en/")]
    rule, verdict = best_rule(URL_RULES, F.col("h"), F.col("p"))
    got = spark.createDataFrame(cases, "h string, p string").select("h", "p", rule, verdict).collect()
    assert [tuple(r) for r in got] == [(h, p, *rule_of(h, p)) for h, p in cases]


def test_kinds_of_segments(spark):
    cases = {
        "123": "{number}", "12.html": "{number}.html", "2024-01-31": "{date}", "news": "news", "deadbeef": "deadbeef", "deadbee1": "{hex}",
        "0b3c2f10-aaaa-bbbb-cccc-0123456789ab": "{uuid}", "a-long-slug-with-number-7": "{code}", "1.2": "{number}.2", "v1": "v1",
    }
    got = spark.createDataFrame([(k,) for k in cases], "s string").select(kind_of(F.col("s"))).collect()
    assert [r[0] for r in got] == list(cases.values())
    deep = spark.createDataFrame([("/" + "a/" * 20,), ("//a///b/",), ("",)], "p string").select(segments_of(F.col("p"))).collect()
    assert [r[0] for r in deep] == [["a"] * 8 + ["**"], ["a", "b"], []]


def pages_and_labels():
    """A shop whose ``ads`` branch is bad, many language branches that are alike, and slugs without support."""
    pages, bad = [], []

    def add(url, is_bad):
        pages.append((len(pages), url))
        if is_bad is not None:
            bad.append((len(pages) - 1, int(is_bad)))

    for i in range(60):
        for language in ("en", "fr", "de"):
            add(f"http://shop.com/{language}/item/{i}", i % 20 == 0)
        add(f"http://shop.com/ads/item/{i}", i % 20 != 0)
        add(f"http://shop.com/blog/slug-{'x' * (i % 7)}{chr(97 + i % 26)}{chr(97 + i // 26)}", i % 20 == 0 if i % 2 else None)
    return pages, bad


@pytest.fixture(scope="module")
def judged(spark):
    pages, bad = pages_and_labels()
    frame = spark.createDataFrame([(*p, "h", 1) for p in pages], "page_id long, url string, host string, page int")
    labels = spark.createDataFrame(bad, "page long, bad int")
    return {r["page_id"]: r for r in judge_urls(frame, labels).collect()}


def test_templates_and_verdicts(judged):
    pages, _ = pages_and_labels()
    templates = defaultdict(set)
    for i, url in pages:
        templates[url.split("/")[3]].add(judged[i]["template"])
    assert templates["ads"] == {"ads/item/{number}"}  # too bad to be merged
    assert templates["en"] == templates["fr"] == templates["de"] == {"*/item/{number}"}
    assert templates["blog"] == {"blog/*"}  # another shape
    for i, url in pages:
        assert judged[i]["verdict"] == ("block" if "/ads/" in url else "allow")


def test_shares_are_smoothed_counts(judged):
    pages, bad = pages_and_labels()
    labels = dict(bad)
    of_template = defaultdict(list)
    for i, _ in pages:
        if i in labels:
            of_template[judged[i]["template"]].append(labels[i])
    known, worst = len(labels), sum(labels.values())
    overall = (worst + 1) / (known + 2)
    host = (worst + url_templates.TRUST * overall) / (known + url_templates.TRUST)
    for i, _ in pages:
        own = of_template[judged[i]["template"]]
        want = (sum(own) + url_templates.TRUST * host) / (len(own) + url_templates.TRUST)
        assert judged[i]["bad_share"] == pytest.approx(want)


def test_sections_that_differ_below_the_eighth_segment(spark):
    deep, pages, bad = "a/b/c/d/e/f/g/h/i", [], []
    for i in range(60):
        for section in ("good", "fine", "ads"):
            pages.append((len(pages), f"http://deep.com/{deep}/{section}/{i}"))
            bad.append((len(pages) - 1, int(i % 20 != 0 if section == "ads" else i % 20 == 0)))
    judged = judge_urls(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(bad, "page long, bad int")).collect()
    urls = dict(pages)
    assert all(r["verdict"] == ("block" if "/ads/" in urls[r["page_id"]] else "allow") for r in judged)
    assert {r["template"] for r in judged} == {f"{deep}/ads/{{number}}", f"{deep}/*/{{number}}"}


def test_nulls_repetitions_and_no_rows(spark):
    pages = [(1, None), (1, "http://a.net/x"), (1, "http://a.net/x"), (None, "http://a.org/fr/1"), (2, "nothing"), (3, "http://h/" + "p/" * 5000), (4, "")]
    frame = spark.createDataFrame(pages, "page_id long, url string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None)], "page long, bad int")
    rows = judge_urls(frame, labels, URL_RULES).collect()
    assert len(rows) == len(pages)
    for r in rows:
        rule, verdict = rule_of(r["host"], r["path"])
        assert r["rule"] == rule and r["verdict"] in ((verdict,) if verdict else ("allow", "block"))
    assert sorted(r["host"] for r in rows) == ["", "", "", "a.net", "a.net", "a.org", "h"]
    assert judge_urls(frame.where("false"), labels).collect() == []
    assert judge_urls(frame, labels.where("false")).count() == len(pages)


def test_critical_values(spark):
    got = spark.createDataFrame([(1.0,), (2.0,), (5.0,), (10.0,)], "f double").select(url_templates._critical(F.col("f"))).collect()
    for row, want in zip(got, (6.635, 9.210, 15.086, 23.209)):
        assert row[0] == pytest.approx(want, rel=0.03)


def test_patterns_compile():
    assert all(re.compile(p) for p in url_templates.KINDS.values())


def merged_branches(paths, level):
    """Brute force of one level: (host, before, segment) of the branches that become a wildcard."""

    def shape(segments):
        return "/".join(s if s.startswith("{") or s == "**" else "w" for s in segments)

    cells, branches = defaultdict(lambda: [0, 0, 0]), defaultdict(lambda: [0, 0, 0])
    for host, template, *sums in paths:
        if len(template) > level:
            branch = (host, "/".join(template[:level]), template[level])
            for key, held in (((*branch, shape(template[level + 1 :])), cells), (branch, branches)):
                held[key] = [a + b for a, b in zip(held[key], sums)]
    main = {b: max((n[0], k[3]) for k, n in cells.items() if k[:3] == b)[1] for b in branches}
    kin_of = {b: (*b[:2], main[b]) for b, n in branches.items() if n[0] >= url_templates.SUPPORT}

    def agrees(branch, share, quantile):
        _, labelled, bad = branches[branch]
        return abs(bad - share * labelled) <= quantile * (share * (1 - share) * labelled) ** 0.5 + 0.5

    chosen = [(b, (*b[:2], "rare")) for b, n in branches.items() if n[0] < url_templates.SUPPORT]
    for kin in set(kin_of.values()):
        own = [b for b in kin_of if kin_of[b] == kin]
        shares = sorted(branches[b][2] / branches[b][1] for b in own if branches[b][1])
        least = 1 / (sum(branches[b][1] for b in own) + 2)
        middle = shares[(len(shares) + 1) // 2 - 1] if shares else 0.5
        near = [b for b in own if agrees(b, max(least, min(1 - least, middle)), 2 * url_templates.QUANTILE)]
        if not near:
            continue
        share = (sum(branches[b][2] for b in near) + 1) / (sum(branches[b][1] for b in near) + 2)
        clean = [b for b in own if agrees(b, share, url_templates.QUANTILE)]
        together = defaultdict(int)
        for key, n in cells.items():
            if key[:3] in clean:
                together[key[3]] += n[0]
        for b in clean:
            distance = branches[b][0]
            for rest, n in ((k[3], n[0]) for k, n in cells.items() if k[:3] == b):
                expected = branches[b][0] * together[rest] / sum(together.values())
                distance += (n - expected) ** 2 / expected - expected
            freedom = max(len(together) - 1, 1)
            spread = 2 / (9 * freedom)
            if len(together) == 1 or distance <= freedom * (1 - spread + 2.326 * spread**0.5) ** 3:
                chosen.append((b, kin))
    count = defaultdict(int)
    for _, kin in chosen:
        count[kin] += 1
    return {b for b, kin in chosen if count[kin] > 1}


@pytest.mark.parametrize("seed", range(6))
def test_the_tree_against_brute_force(spark, seed):
    rng = random.Random(seed)
    paths = {}
    for host in ("a.x", "b.x"):
        sections = [f"s{i}" for i in range(rng.randint(2, 6))]
        for _ in range(60):
            tail = [rng.choice(["{number}", "{date}", "list", "view", f"p{rng.randint(0, 5)}"]) for _ in range(rng.randint(0, 3))]
            segments = (rng.choice(sections), *tail)[: rng.randint(0, 4)]
            labelled = rng.randint(0, 10)
            bad = sum(rng.random() < (0.8 if segments[:1] == ("s0",) else 0.1) for _ in range(labelled))
            paths[host, segments] = (rng.randint(labelled + 1, labelled + 12), labelled, bad)
    rows = [(h, "/".join(s), list(s), *sums) for (h, s), sums in paths.items()]
    frame = spark.createDataFrame(rows, "host string, typed string, segments array<string>, n long, labelled long, bad long")
    got = {(r["host"], r["typed"]): r["template"] for r in url_templates.learn_templates(frame).collect()}
    want = [[h, list(s), *sums] for (h, s), sums in paths.items()]
    for level in range(4):
        wild = merged_branches(want, level)
        for row in want:
            if len(row[1]) > level and (row[0], "/".join(row[1][:level]), row[1][level]) in wild:
                row[1][level] = url_templates.WILDCARD
    assert got == {(h, "/".join(s)): row[1] for (h, s), row in zip(paths, want)}
    assert any(url_templates.WILDCARD in t for t in got.values())


def test_planted_sections_by_held_out_labels(spark):
    """One bad section per host, labels for half of the pages: the verdicts on the other half."""
    rng = random.Random(4)
    pages, truth = [], {}
    for h in range(4):
        for section in ("news", "blog", "shop", "casino"):
            for _ in range(80):
                page = len(pages)
                pages.append((page, f"http://h{h}.x/{section}/{rng.randint(1, 9999)}/{rng.choice(['a', 'b'])}{rng.randint(0, 99)}.html"))
                truth[page] = rng.random() < (0.9 if section == "casino" else 0.04)
    labels = [(p, int(bad)) for p, bad in truth.items() if p % 2 == 0]
    judged = judge_urls(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "page long, bad int"))
    blocked = {r["page_id"] for r in judged.collect() if r["verdict"] == "block" and r["page_id"] % 2}
    bad = {p for p, b in truth.items() if b and p % 2}
    assert len(blocked & bad) >= 0.85 * len(blocked) and len(blocked & bad) >= 0.8 * len(bad)


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "http://a.b/c", "x", 1, "y")], "page_id long, url string, host string, bad int, template string")
    (row,) = judge_urls(df, spark.createDataFrame([(1, 1)], "page long, bad int")).collect()
    assert (row["host"], row["path"]) == ("a.b", "/c")
