"""Mixing against exact arithmetic, tokens against the sentencepiece library, vectors against brute force."""

from __future__ import annotations

import collections
import hashlib
from fractions import Fraction

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from silverlode.llm import pieces, vectors
from silverlode.llm.mixing import mix_counts, mixed, mixed_rows, ranked_sources
from silverlode.llm.queries import sentencepiece_model

from tests.llm.conftest import AWKWARD, prose, words

SMALL = "/root/testdata/sf0.001"


def brute_mix(rows, weights, share, epochs):
    """Targets by exact water-filling; words taken by cutting the seeded order."""
    size = [len(words(t)) for _, t, _ in rows]
    total = collections.Counter()
    for (_, _, s), n in zip(rows, size, strict=True):
        total[s] += n
    names = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, clamped = Fraction(share) * sum(total.values()), set()
    while True:
        free = [s for s in names if s not in clamped]
        if not free:
            break
        level = (budget - sum(epochs * total[s] for s in clamped)) / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > epochs * total[s]}
        if not over:
            break
        clamped |= over
    return {s: float(epochs * total[s] if s in clamped else weight[s] * level) for s in names}, size


def mixing_rows():
    rows = [(i, prose(i, 5 + i * 7 % 90), ["a", "b", "é", None, "Z"][i % 5 if i % 3 else 0]) for i in range(400)]
    return rows + [(1000 + i, prose(i, 3), "tiny") for i in range(3)] + [(2000, None, "void")]


def test_mixing_reaches_its_targets(llm):
    rows = mixing_rows()
    docs = llm.createDataFrame(rows, "doc_id long, text string, source string")
    out = mix_counts(docs, (5, 2, 1), 1.5).collect()
    target, size = brute_mix(rows, (5, 2, 1), "1.5", 2)
    by_id = {r[0]: n for r, n in zip(rows, size, strict=True)}
    assert len(out) == len(rows)
    taken, largest = collections.Counter(), collections.Counter()
    for r in out:
        assert r.size == by_id[r.doc_id] and r.target == pytest.approx(target[r.source])
        assert r.taken == r.size * r.repeats and 0 <= r.repeats <= 2
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s, t in target.items():
        assert abs(taken[s] - t) <= largest[s] / 2 + 1e-6
    assert target["tiny"] == 2 * 9 * 1.0 or taken["tiny"] == pytest.approx(target["tiny"], abs=3)
    # Reruns and other partitionings agree.
    again = mix_counts(docs.repartition(7), (5, 2, 1), 1.5).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))
    # In a seeded order, a prefix is taken once more than the rest.
    for s in target:
        order = sorted((hashlib.md5(f"17:{r.doc_id}".encode()).hexdigest(), r.repeats) for r in out if r.source == s and r.size)
        assert [x for _, x in order] == sorted((x for _, x in order), reverse=True)


@pytest.mark.parametrize("share,weights,epochs", [(2.0, (1,), 2), (3.0, (5, 1), 2), (0.1, (1, 9), 1), (1.0, (100, 1), 3)])
def test_mixing_at_its_edges(llm, share, weights, epochs):
    rows = mixing_rows()
    docs = llm.createDataFrame(rows, "doc_id long, text string, source string")
    target, _ = brute_mix(rows, weights, str(share), epochs)
    for r in mix_counts(docs, weights, share, epochs).collect():
        assert r.target == pytest.approx(target[r.source]) and r.repeats <= epochs


@pytest.mark.parametrize("doc_id", [7, None])
def test_equal_rows_are_taken_one_by_one(llm, doc_id):
    # 150 of 100 words: every row once, and five of the ten equal ones once more.
    rows = [(doc_id, " ".join(["same"] * 10), "a")] * 10
    docs = llm.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    counts = mix_counts(docs, (1,), 1.5).collect()
    assert sorted(r.taken for r in counts) == [10] * 5 + [20] * 5
    assert mixed_rows(docs, (1,), 1.5).count() == 15
    others = llm.createDataFrame([(i, "one two three", "b") for i in range(30)], docs.schema)
    both = mix_counts(docs.unionByName(others), (1, 1), 1.5).groupBy("source").agg(F.sum("taken").alias("n"), F.max("target").alias("t"))
    assert all(abs(r.n - r.t) <= 5 for r in both.collect())


def test_sources_are_ranked_over_partitions(llm):
    names = [f"s{i:03d}" for i in range(500)] + ["É", "é", "Z", "", None]
    sizes = llm.createDataFrame([(n, 1) for n in names], "source string, size long").repartition(8)
    got = {r.source: r["rank"] for r in ranked_sources(sizes).collect()}
    assert [got[n] for n in sorted((n for n in names if n is not None), key=str.encode)] == list(range(504))
    assert got[None] == 504


def test_mixing_of_awkward_rows(awkward, no_documents):
    out = mix_counts(awkward, (5, 2, 1), 1.5)
    rows = out.collect()
    assert len(rows) == len(AWKWARD)
    assert {r.size for r in rows if r.doc_id in (1, 2, 3)} == {0} and {r.size for r in rows if r.doc_id == 6} == {300_000}
    repeated = mixed(awkward, out)
    assert repeated.columns == awkward.columns
    assert sum(len(words(r.text)) for r in repeated.collect()) == sum(r.taken for r in rows if r.doc_id is not None)
    assert mix_counts(no_documents, (5, 2, 1), 1.5).collect() == []


HARD = [
    "", " ", "  a  b ", "\n\n x", "日本語テキスト 🎉🎉", "<s> hello </s> <unk>", "a▁b", "\x00\x01", "ⅷ ﬁ", "tab\tx",
    "<0x41>", "á́", "a" * 60, "x" * 5000, "▁▁▁", "end ", "ÀÉ İstanbul ẞ Σ", "a　b", "﻿",
]


def test_encoder_has_the_ids_of_sentencepiece():
    data = sentencepiece_model()
    theirs = sentencepiece.SentencePieceProcessor(model_proto=data)
    model = pieces.parse_model(data)
    encoder, whole = pieces.Encoder(model), pieces.build(model)
    assert encoder.by_unit
    texts = HARD + [prose(i, 200) for i in range(20)] + [" ".join(HARD)]
    for text in texts:
        ids = theirs.encode(text)
        flat, counts, same = encoder.encode([text])
        assert flat.tolist() == ids == whole.encode(text, add_special_tokens=False).ids and counts.tolist() == [len(ids)]
        assert same.all() and whole.decode(ids, skip_special_tokens=False) == pieces.normalized(model, text)
    flat, counts, _ = encoder.encode(texts)
    assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == [theirs.encode(t) for t in texts]


def field(number, value):
    """One protobuf field."""

    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    if isinstance(value, float):
        return varint(number << 3 | 5) + np.float32(value).tobytes()
    return varint(number << 3 | 2) + varint(len(value)) + value


def unigram_model(extra=b"") -> bytes:
    """A small unigram model, written by hand; nothing is trained."""
    scored = {"▁a": -2.0, "▁ab": -2.5, "b": -3.0, "▁": -1.5, "a": -2.2, "abc": -4.0, "c": -3.5, "bc": -3.6, "▁b": -2.9}
    out = field(1, field(1, b"<unk>") + field(2, 0.0) + field(3, 2))
    out += field(1, field(1, b"<s>") + field(2, 0.0) + field(3, 3)) + field(1, field(1, b"</s>") + field(2, 0.0) + field(3, 3))
    for piece, score in scored.items():
        out += field(1, field(1, piece.encode()) + field(2, score))
    return out + extra + field(2, field(3, 1)) + field(3, field(1, b"identity") + field(3, 1) + field(4, 1) + field(5, 1))


def test_round_trip_tells_of_the_ids_of_the_whole_text():
    encoder = pieces.Encoder(pieces.parse_model(sentencepiece_model()))
    texts = ["some words of a text", "other words", ""]
    assert encoder.encode(texts)[2].tolist() == [True, True, True]
    # Units are remembered with their ids; wrong ones must show in the text.
    encoder.flat[encoder.starts[encoder.place[" some"]]] += 1
    assert encoder.encode(texts)[2].tolist() == [False, True, True]


def test_unigram_models_have_the_ids_of_sentencepiece():
    data = unigram_model()
    theirs = sentencepiece.SentencePieceProcessor(model_proto=data)
    encoder = pieces.Encoder(pieces.parse_model(data))
    for text in ["", "a", "ab abc", "  cab  bca ", "abcabcabc a b c", "zz ab", "a  b", "az b"]:
        flat, _, same = encoder.encode([text])
        assert flat.tolist() == theirs.encode(text), text
        assert same[0] == ("z" not in text), text


def test_encoding_and_decoding_of_awkward_rows(llm, awkward, no_documents):
    data = sentencepiece_model()
    out = pieces.encoded(awkward, data, ["doc_id", "source", "bytes"])
    assert out.columns == ["doc_id", "source", "bytes", "ids", "n_tokens", "round_trip"]
    rows = out.collect()
    assert len(rows) == len(AWKWARD) and all(r.round_trip and r.n_tokens == len(r.ids) for r in rows)
    back = {r.doc_id: r.text for r in pieces.decoded(out.where("doc_id is not null"), data, ["doc_id"]).collect()}
    assert back == {i: t or "" for i, t, *_ in AWKWARD if i is not None}
    assert pieces.encoded(no_documents, data, ["doc_id"]).collect() == []


def test_parity_over_a_whole_table(llm):
    docs = llm.read.parquet(f"{SMALL}/documents.parquet")
    same = pieces.parity(docs, sentencepiece_model())
    assert same.count() == docs.count() and same.where("not same").count() == 0


def brute_nearest(rows, k, step):
    ids, m = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    out = {}
    for i in np.flatnonzero(ids % step == 0):
        s = np.sqrt(((m - m[i]) ** 2).sum(1))
        s[i] = np.inf
        order = np.lexsort((ids, s))[: min(k, len(ids) - 1)]
        out[int(ids[i])] = [(int(ids[j]), s[j]) for j in order]
    return out


def test_vector_recall_and_exact_scores(llm):
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(30, 24))
    points = np.concatenate((centers[rng.integers(0, 30, 3000)] + rng.normal(size=(3000, 24)) / 2, rng.normal(size=(1000, 24))))
    rows = [(int(i), p.tolist()) for i, p in enumerate(points)]
    rows += [(5000 + i, points[7].tolist()) for i in range(300)]
    df = llm.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    settings = vectors.Settings(list_size=64, vector_block=100, query_block=10)
    expected = brute_nearest(rows, 10, 20)
    got = collections.defaultdict(list)
    for r in vectors.nearest(df, F.col("vec_id") % 20 == 0, settings=settings).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    assert set(got) == set(expected)
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in near}) for q, near in expected.items())
    assert hits / (10 * len(expected)) >= 0.95
    by_id = dict(rows)
    for q, near in got.items():
        assert near == sorted(near, key=lambda x: (x[1], x[0])) and q not in dict(near)
        for v, s in near:
            assert s == pytest.approx(np.linalg.norm(np.array(by_id[q]) - np.array(by_id[v])), abs=1e-12)
    # Equal vectors: ties go to the smaller ids, the query itself left out.
    assert [v for v, _ in got[5020]] == [7, *range(5000, 5009)] and [s for _, s in got[5020]] == [0.0] * 10


def test_awkward_vectors_take_no_part(llm):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (7, [1.0]), (None, [1.0, 1.0]), (8, []), (0, [1.0, 0.0]), (20, [1.0, 1.0])]
    df = llm.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<float>, cls string, vec string")
    got = [tuple(r) for r in vectors.nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 20, 1.0), (0, 2, 1, 2**0.5), (20, 1, 0, 1.0), (20, 2, 1, 1.0)]
    assert vectors.nearest(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []
