"""Every stage of the pipeline against brute force, on what the stage before it kept."""

from __future__ import annotations

import collections

import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from silverlode.llm import toxicity
from silverlode.llm.common import materialize
from silverlode.llm.queries import QUERIES, sentencepiece_model
from tests.llm.conftest import prose, words
from tests.llm.test_duplicates import brute_components
from tests.llm.test_filters import brute_lines
from tests.llm.test_mixing_tokens_vectors import brute_mix

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(llm):
    """The documents, and what each stage makes of them."""
    out = [llm.read.parquet(f"{SMALL}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(llm, out[-1], SMALL), "stage"))
    return out


def test_all_but_the_last_stage_return_documents(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    assert stages[-1].columns == ["doc_id", "lang", "source", "ids", "n_tokens", "round_trip"]


def test_toxic_documents_go(llm, stages):
    labels = llm.read.parquet(f"{SMALL}/labels.parquet")
    rejected = {r.doc_id for r in toxicity.toxicity(stages[0], labels).collect() if r.predicted}
    assert rejected and {r.doc_id for r in stages[1].collect()} == {r.doc_id for r in stages[0].collect()} - rejected
    known = {r.doc_id: r.toxic for r in labels.collect()}
    assert sum(known.get(i) == 0 for i in rejected) <= 1


def test_boilerplate_lines_go(stages):
    before = [(r.doc_id, r.text, r.source) for r in stages[1].collect()]
    expected = {i: text for i, text, *_ in brute_lines(before, 0.1, 3)}
    got = {r.doc_id: r for r in stages[2].collect()}
    assert {i: r.text for i, r in got.items()} == expected
    assert all(r.n_chars == len(r.text) for i, r in got.items() if r.text != dict((a, b) for a, b, _ in before)[i])


def test_one_document_of_each_group_stays(stages):
    texts = {r.doc_id: r.text for r in stages[2].collect()}
    assert {r.doc_id for r in stages[3].collect()} == set(brute_components(texts, 5).values())


def test_sources_reach_their_targets(stages):
    rows = [(r.doc_id, r.text, r.source) for r in stages[3].collect()]
    target, _ = brute_mix(rows, (5, 2, 1), "1.5", 2)
    taken, times = collections.Counter(), collections.Counter()
    for r in stages[4].collect():
        taken[r.source] += len(words(r.text))
        times[r.doc_id] += 1
    longest = collections.Counter()
    for _, text, source in rows:
        longest[source] = max(longest[source], len(words(text)))
    assert all(abs(taken[s] - t) <= longest[s] / 2 + 1e-6 for s, t in target.items()) and max(times.values()) <= 2


def test_mixing_counts_rows_without_an_id_and_rows_that_share_one_by_themselves(llm):
    # Every source holds null ids and ids that it shares with others.
    rows = [(i if i % 4 else None, prose(i, 5 + i % 40), "abcdef"[i % 6]) for i in range(300)]
    rows += [(i, prose(900 + i, 20 + i % 7), "abcdef"[(i + 1) % 6]) for i in range(1, 300, 9)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, source string")
    out = corpus_pipeline.mix_sources(llm, docs, SMALL)
    assert out.columns == docs.columns
    times = collections.Counter((r.doc_id, r.text, r.source) for r in out.collect())
    target, _ = brute_mix(rows, (5, 2, 1), "1.5", 2)
    taken, longest = collections.Counter(), collections.Counter()
    for row in rows:
        n = len(words(row[1]))
        taken[row[2]] += n * times[row]
        longest[row[2]] = max(longest[row[2]], n)
    assert set(times) <= set(rows) and max(times.values()) == 2
    assert any(i is None for i, *_ in times)
    assert all(abs(taken[s] - t) <= longest[s] / 2 + 1e-6 for s, t in target.items())


def test_tokens_are_those_of_sentencepiece(stages):
    theirs = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model())
    expected = sorted((r.doc_id, theirs.encode(r.text)) for r in stages[4].collect())
    got = stages[5].collect()
    assert sorted((r.doc_id, list(r.ids)) for r in got) == expected
    assert all(r.round_trip for r in got)


def test_run_applies_all_stages(llm, stages):
    ran = corpus_pipeline.run(llm, SMALL)
    assert sorted(map(str, ran.collect())) == sorted(map(str, stages[-1].collect()))


@pytest.mark.parametrize("number", range(1, 11))
def test_every_operator_has_a_query(number):
    assert sum(name.startswith(f"op{number}_") for name in QUERIES) == 1


def test_stages_keep_columns_of_any_name(llm, awkward):
    docs = awkward.withColumns({c: F.lit("mine") for c in ("_lines", "_dropped", "_toxicity", "row", "keys", "rest", "of")})
    for stage in (corpus_pipeline.drop_boilerplate, corpus_pipeline.drop_near_duplicates, corpus_pipeline.mix_sources):
        kept = stage(llm, docs, SMALL)
        assert kept.columns == docs.columns and kept.where("_lines = 'mine'").count() > 0
