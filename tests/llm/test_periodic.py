"""Periodic runs against a brute-force search, and the registered query on a small table."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from silverlode.llm import queries
from silverlode.llm.periodic import collapsed, periodic_runs, runs, text_runs
from tests.llm.conftest import AWKWARD, DOCUMENTS, prose


def brute(letters, min_length, min_exponent):
    """Maximal stretches of equal letters ``q`` apart, for every ``q``, that have no smaller period."""
    out = []
    for q in range(1, len(letters) // min_exponent + 1):
        i = 0
        while i + q < len(letters):
            start = i
            while i + q < len(letters) and letters[i] == letters[i + q]:
                i += 1
            size = i + q - start
            part = letters[start : start + size]
            if size >= max(min_length, min_exponent * q) and not any(part[:-d] == part[d:] for d in range(1, q)):
                out.append((start, size, q))
            i += 1
    return sorted(out)


@pytest.mark.parametrize("bounds", [(1, 2), (6, 2), (6, 3), (24, 3), (10, 4)])
def test_runs_equal_brute_force(bounds):
    rng = random.Random(7)
    for _ in range(400):
        noise = [rng.randrange(rng.choice([1, 2, 2, 3])) for _ in range(rng.randint(0, 50))]
        period = [rng.randrange(40) for _ in range(rng.randint(1, 8))]
        letters = noise + period * rng.randint(0, 9) + period[: rng.randint(0, 8)] + noise[: rng.randint(0, 20)]
        expected = brute(letters, *bounds)
        assert runs(letters, *bounds) == expected
        assert text_runs([b"%d" % x for x in letters], *bounds) == expected


def test_words_meet_many_runs():
    # Runs of periods 1 and 5 overlap in one word.
    words = [b"a"] * 24 + [b"b", b"c", b"d", b"e", b"a"] * 6
    assert text_runs(words, 24, 3) == [(0, 24, 1), (23, 31, 5)]
    assert collapsed(words, [(0, 24, 1), (23, 31, 5)]) == b"a b c d e"[:1] + b" b c d e"


def test_periodic_prefix_of_hundred_thousand_words():
    words = [b"%d" % (i % 997) for i in range(100_000)]
    assert text_runs(words, 24, 3) == [(0, 100_000, 997)]
    assert text_runs([b"x"] * 100_000, 24, 3) == [(0, 100_000, 1)]


def test_awkward_rows(awkward, no_documents):
    found = periodic_runs(awkward).collect()
    assert len(found) == len(AWKWARD)
    by_id = {r["doc_id"]: r for r in found if r["doc_id"] is not None}
    assert [by_id[i]["collapsed"] for i in (1, 2, 3)] == ["", "", ""]
    assert by_id[4]["collapsed"] == "ÀÉ İstanbul ẞ Σ" and sum(r["doc_id"] == 4 for r in found) == 2
    assert [tuple(r) for r in by_id[6]["runs"]] == [(0, 300_000, 1)] and by_id[6]["collapsed"] == "word"
    assert sum(r["doc_id"] is None for r in found) == 2
    assert periodic_runs(no_documents).count() == 0


def expected_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words, 24, 3)
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else (None, None, None)
    lines = "".join(f"{s},{size},{q}\n" for s, size, q in found).encode()
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    milli = 1000 * best[1] // best[2] if found else None
    return (doc_id, len(found), *best, milli, hashlib.sha256(lines).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_equals_brute_force(llm, tmp_path, rows):
    texts = [(i, prose(i, 30 + 7 * (i % 40)), "en", "s", 1) for i in range(300)]
    line = prose(1000, 9)
    texts += [(300 + i, f"{prose(i, 20)}\n" + f"{line}\n\t{line} " * (i % 5), "en", "s", 1) for i in range(100)]
    texts += [r for r in AWKWARD if len(r[1] or "") < 1000]
    # An id with a periodic tail that has no text, no words and one word.
    chosen = [i for i in range(5000, 6000) if zlib.crc32(str(i).encode()) % 10 == 0][:4]
    texts += [(i, t, "en", "s", 1) for i, t in zip(chosen, [None, "", " \n", "one"], strict=True)]
    llm.createDataFrame(texts, DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.QUERIES["op11_periodic_runs"](llm, str(tmp_path))
    expected = sorted((expected_row(t[0], t[1]) for t in texts), key=repr)
    assert rows(found) == expected
    assert found.where(F.col("n_runs") > 0).count() > 40
