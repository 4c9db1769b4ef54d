"""URL reputation, toxicity, weak-label quality and site lines."""

from __future__ import annotations

import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from silverlode.llm import toxicity, weak_quality
from silverlode.llm.linear import Settings, ftrl
from silverlode.llm.site_lines import cleaned_lines
from silverlode.llm.url_reputation import Rule, domain_and_suffix, host_and_path, judge_urls, outcomes_of_copies

from tests.llm.conftest import AWKWARD, CLASHING, prose

SMALL = "/root/testdata/sf0.001"
RULES = [Rule("block", "net/"), Rule("allow", "example.net/en/"), Rule("block", "a.com/de/"), Rule("allow", "org/fr/")]


def test_host_path_and_rules(llm):
    urls = [
        "http://WWW.A.com/de/x?q#f", "https://a.com", "https://a.com/de", "ftp://b.net#x", "https://example.net/en/1",
        "https://Éa.org/fr/", "no url", None, "", "://h/p", "http://?x", "https://x://y/z",
    ]
    df = llm.createDataFrame([(u,) for u in urls], "url string")
    assert [tuple(r) for r in df.select(*host_and_path(F.col("url"))).collect()] == [
        ("www.a.com", "/de/x"), ("a.com", ""), ("a.com", "/de"), ("b.net", ""), ("example.net", "/en/1"),
        ("Éa.org", "/fr/"), ("", ""), ("", ""), ("", ""), ("h", "/p"), ("", ""), ("x:", "//y/z"),
    ]
    pages = df.withColumn("page_id", F.monotonically_increasing_id())
    none = llm.createDataFrame([], "page_id long, good int")
    rows = {r.host + r.path: (r.rule, r.verdict) for r in judge_urls(pages, none, RULES, []).collect()}
    assert rows["www.a.com/de/x"] == ("a.com/de/", "block")
    assert rows["a.com"] == rows["a.com/de"] == (None, "allow")
    # The path must start with the rule's.
    assert rows["b.net"] == (None, "allow")
    assert rows["example.net/en/1"] == ("example.net/en/", "allow")
    assert rows["Éa.org/fr/"] == ("org/fr/", "allow")


def test_suffixes_of_country_domains(llm):
    hosts = {
        "news.site.co.uk": ("site.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "a.b.com.au": ("b.com.au", "com.au"),
        "site.uk": ("site.uk", "uk"), "co.example.de": ("example.de", "de"), "x.com.de": ("com.de", "de"), "uk": ("uk", "uk"), "": ("", ""),
    }
    df = llm.createDataFrame([(h,) for h in hosts], "h string")
    found = df.select("h", *[c.alias(n) for c, n in zip(domain_and_suffix(F.col("h"), ["example.com"]), "ds", strict=True)])
    assert {r.h: (r.d, r.s) for r in found.collect()} == hosts


def test_domain_and_suffix(llm):
    hosts = ["a.b.example.com", "b.example.com", "example.com", "x.y.org", "org", ""]
    df = llm.createDataFrame([(h,) for h in hosts], "h string")
    assert [tuple(r) for r in df.select(*domain_and_suffix(F.col("h"), ["example.com"])).collect()] == [
        ("b.example.com", "example.com"), ("b.example.com", "example.com"), ("example.com", "example.com"),
        ("y.org", "org"), ("org", "org"), ("", ""),
    ]


def brute_reputation(outcomes, z=1.645):
    """The same shrinkage in plain Python, for hosts of one label before the suffix."""
    host = collections.defaultdict(lambda: [0.0, 0.0])
    for h, good in outcomes:
        host[h][0] += good or 0
        host[h][1] += good is not None
    up = lambda h: h.rpartition(".")[2]
    total = [sum(v[i] for v in host.values()) for i in (0, 1)]
    top = (total[0] + 1) / (total[1] + 2)

    def level(groups, mean):
        extra = pairs = 0.0
        for name, (good, n) in groups.items():
            if n:
                p = mean(name)
                extra += (good - n * p) ** 2 - n * p * (1 - p)
                pairs += n * (n - 1) * p * (1 - p)
        strength = 2.0 if not pairs else 1000.0 if extra <= 0 else min(1000.0, max(2.0, pairs / extra - 1))
        return {k: (g + strength * mean(k)) / (n + strength) for k, (g, n) in groups.items()}, strength

    suffix = collections.defaultdict(lambda: [0.0, 0.0])
    for h, (g, n) in host.items():
        suffix[up(h)][0] += g
        suffix[up(h)][1] += n
    by_suffix, _ = level(suffix, lambda s: top)
    by_domain, _ = level(host, lambda h: by_suffix[up(h)])
    by_host, strength = level(host, lambda h: by_domain[h])
    out = {}
    for h, m in by_host.items():
        out[h] = (m, m + z * math.sqrt(m * (1 - m) / (host[h][1] + strength + 1)))
    return out


def test_reputation_equals_plain_python(llm):
    rng = np.random.default_rng(1)
    rows, outcomes = [], []
    for k in range(40):
        h = f"h{k}.{'com' if k % 3 else 'org'}"
        bad = k % 5 == 0
        for _ in range(int(rng.integers(1, 60))):
            good = None if rng.random() < 0.3 else int(rng.random() < (0.1 if bad else 0.9))
            rows.append((len(rows), f"http://{h}/x"))
            outcomes.append((h, good))
    pages = llm.createDataFrame(rows, "page_id long, url string")
    labels = [(i, g) for i, (_, g) in enumerate(outcomes) if g is not None]
    judged = judge_urls(pages, llm.createDataFrame(labels, "page_id long, good int"), [], []).collect()
    expected = brute_reputation(outcomes)
    for r in judged:
        mean, bound = expected[r.host]
        assert r.reputation == pytest.approx(mean) and r.bound == pytest.approx(bound)
        assert r.verdict == ("block" if bound < 0.7 else "allow")
    assert {r.verdict for r in judged} == {"block", "allow"}


def test_urls_of_awkward_rows(llm):
    pages = [(1, "http://a.com/3"), (1, "http://a.com/3"), (None, "http://a.com/3"), (2, None), (3, "")]
    pages = llm.createDataFrame([(*p, "x", "y") for p in pages], "page_id long, url string, host string, bound string")
    labels = llm.createDataFrame([(3, 1, 0), (3, 0, None), (None, 1, 1), (4, None, 1)], "doc_id long, quality int, toxic int")
    outcomes = outcomes_of_copies(pages, labels)
    assert {tuple(r) for r in outcomes.collect()} == {(1, 0), (None, 0)}
    rows = judge_urls(pages, outcomes, RULES, []).collect()
    assert sorted(str(r.page_id) for r in rows) == ["1", "1", "2", "3", "None"]
    assert judge_urls(pages.limit(0), outcomes.limit(0), RULES, []).collect() == []


def labelled(llm, n=400):
    rows, labels = [], []
    for i in range(n):
        text = prose(i, 60).split(" ")
        toxic = i % 4 == 0
        if toxic:
            text[10 + i % 40] = ["Gargh,", "splut!", "wretch"][i % 3]
        rows.append((i, " ".join(text), "en", f"s{i % 3}", 0))
        labels.append((i, 1, int(toxic)))
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs, llm.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(llm):
    docs, labels = labelled(llm)
    rows = toxicity.toxicity(docs, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    out = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == int(r.doc_id % 4 == 0) for r in out]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, toxicity.toxicity(docs, labels).collect()))
    # Labels of held-out rows change nothing.
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert sorted(map(tuple, rows)) == sorted(map(tuple, toxicity.toxicity(docs, turned).collect()))
    left = toxicity.without_toxic(docs, labels)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in rows if not r.predicted}


def test_toxicity_of_awkward_rows(llm, awkward, no_documents):
    labels = llm.createDataFrame([(4, 1, 1), (4, 0, 0), (99, 1, 1), (None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    rows = toxicity.toxicity(awkward, labels).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    left = toxicity.without_toxic(awkward, labels.limit(0))
    assert left.exceptAll(awkward).count() == 0 == awkward.exceptAll(left).count()
    assert toxicity.toxicity(no_documents, labels).collect() == []


def test_ftrl_ignores_noise_and_finds_the_signal():
    rng = np.random.default_rng(3)
    rows = []
    for i in range(600):
        noise = rng.choice(np.arange(10, 1000), 30, replace=False)
        y = float(i % 3 == 0)
        rows.append((y, np.unique(np.append(noise, 5 if y else 6)).astype(np.int32)))
    _, weights = ftrl(rows, Settings(bits=10))
    assert weights[5] > 1 and weights[6] < 0.2 and np.count_nonzero(weights) < 100


def test_posteriors_follow_the_reliable_labellers():
    rng = np.random.default_rng(5)
    counts, truth = collections.Counter(), {}
    right = [0.95, 0.9, 0.9, 0.85, 0.6, 0.55, 0.5, 0.9, 0.8]
    sums = collections.defaultdict(lambda: [0, 0])
    for _ in range(5000):
        good = rng.random() < 0.7
        digits = [1 if rng.random() < 0.3 else 2 * int(good == (rng.random() < p)) for p in right]
        pattern = sum(d * 3**j for j, d in enumerate(digits))
        counts[pattern] += 1
        sums[pattern][0] += good
        sums[pattern][1] += 1
    found = weak_quality.posteriors(counts)
    wrong = sum(min(abs(round(found[p]) * n - g), n) for p, (g, n) in sums.items())
    assert wrong / 5000 < 0.05 and truth == {}
    assert weak_quality.posteriors({}) == {}


def test_quality_separates_junk(llm):
    good = [(i, prose(i, 80 + i % 50), "en", "s", 0) for i in range(200)]
    junk = []
    for i in range(60):
        w = prose(1000 + i, 80).split(" ")
        made = [" ".join(x + "%%%" for x in w), " ".join(x.upper() + "!!" for x in w), " | ".join(w), " ".join([w[0]] * 90)]
        junk.append((1000 + i, made[i % 4], "en", "s", 0))
    docs = llm.createDataFrame(good + junk, "doc_id long, text string, lang string, source string, n_chars long")
    rows = {r.doc_id: r.kept for r in weak_quality.quality(docs).collect()}
    assert np.mean([rows[i] for i, *_ in good]) > 0.98 and np.mean([rows[i] for i, *_ in junk]) < 0.05


def test_quality_of_awkward_rows(awkward, no_documents):
    rows = weak_quality.quality(awkward).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert weak_quality.quality(no_documents).collect() == []


def brute_lines(rows, ratio, least):
    pages, holds = collections.Counter(), collections.defaultdict(set)
    for at, (_, text, host) in enumerate(rows):
        pages[host] += 1
        for line in (text or "").split("\n"):
            if line.strip(" \t\r"):
                holds[host, line.strip(" \t\r")].add(at)
    bad = {(h, x) for (h, x), p in holds.items() if len(p) >= least and len(p) > ratio * pages[h]}
    out = []
    for i, text, host in rows:
        lines = None if text is None else text.split("\n")
        kept = None if lines is None else [x for x in lines if (host, x.strip(" \t\r")) not in bad]
        out.append((i, None if kept is None else "\n".join(kept), len(lines or []), len(lines or []) - len(kept or [])))
    return sorted(out, key=repr)


@pytest.mark.parametrize("ratio", [0.1, 0.5])
def test_site_lines_equal_brute_force(llm, ratio):
    rows = []
    for i in range(120):
        host = [None, "a", "b", "b"][i % 4]
        lines = [f"line {i}", "Menu", "  Menu\t" if i % 3 else "", "often" if i % 5 < 3 else "seldom", f"half {i % 10}"]
        rows.append((i if i % 7 else None, "\n".join(lines), host))
    rows += [(1, None, "a"), (2, "", "a"), (3, "Menu", "a"), (3, "Menu", "a"), (4, "Menu\nMenu", "c"), (5, "one\r\ntwo", "c")]
    extra = [(*r, "x", "y") for r in rows]
    pages = llm.createDataFrame(extra, "doc_id long, text string, source string, host string, _keys2 string")
    got = cleaned_lines(pages, F.col("source"), ratio=ratio)
    assert got.columns == [*pages.columns, "_lines", "_dropped"]
    got = sorted(((r.doc_id, r.text, r._lines, r._dropped) for r in got.collect()), key=repr)
    assert got == brute_lines(rows, ratio, 3)
    assert any(d for *_, d in got)


def test_site_lines_of_awkward_rows(awkward, no_documents):
    left = cleaned_lines(awkward, F.col("source")).drop("_lines", "_dropped")
    assert left.exceptAll(awkward).count() == 0 == awkward.exceptAll(left).count()
    assert cleaned_lines(no_documents, F.col("source")).collect() == [] and "host" in CLASHING


def test_rejecting_toxic_rows_keeps_columns_of_any_name(llm, awkward):
    docs = awkward.withColumns({"_toxicity": F.lit("mine"), "row": F.lit(1)})
    labels = llm.createDataFrame([(i, 0) for i in range(10)], "doc_id long, toxic long")
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.where("_toxicity = 'mine'").count() == kept.count() > 0
