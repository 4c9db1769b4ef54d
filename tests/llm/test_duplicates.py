"""Near-duplicates, repeated paragraphs and exact duplicates against brute force."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from silverlode.llm import collide, hashing, paragraphs
from silverlode.llm import components as rounds
from silverlode.llm.components import components
from silverlode.llm.exact_stream import exact_duplicates
from silverlode.llm.near_dup import near_duplicates, one_of_each
from silverlode.llm.paragraphs import repeated_paragraphs, without_repeats
from silverlode.session import scratch_path

from tests.llm.conftest import AWKWARD, DOCUMENTS, LOWER, edited, prose, words


def shingles(text, size):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def brute_components(texts: dict[int, str], size: int) -> dict[int, int]:
    sets = {i: shingles(t, size) for i, t in texts.items()}
    best = {i: i for i in texts}

    def root(x):
        while best[x] != x:
            x = best[x]
        return x

    ids = sorted(texts)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                best[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def family() -> dict[int, str]:
    """Copies of a base with few and many changes, chains, exact copies, a shared passage."""
    base, passage = prose(1, 150), prose(2, 90)
    texts = {100 + i: edited(base, i, i % 9) for i in range(60)}
    chain = prose(3, 200)
    for i in range(12):
        texts[300 + i] = chain
        chain = edited(chain, 50 + i, 4)
    texts |= {400 + i: prose(10 + i, 30) + " " + passage for i in range(25)}
    texts |= {500 + i: base for i in range(10)}
    texts |= {600 + i: prose(900 + i, i + 1) for i in range(6)}
    return texts


def test_near_duplicates_equal_brute_force(llm):
    texts = family()
    docs = llm.createDataFrame(list(texts.items()), "doc_id long, text string")
    expected = brute_components(texts, 4)
    rows = near_duplicates(docs, shingle=4).collect()
    assert {r.doc_id: r.component_id for r in rows} == expected
    assert {r.doc_id: r.n_shingles for r in rows} == {i: len(shingles(t, 4)) for i, t in texts.items()}
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    assert len(rows) == len(texts) and len(set(expected.values())) > 30


def crowds() -> dict[int, str]:
    """Near copies that differ from each other, and long texts that share only a passage."""
    base, other, passage = prose(21, 150), prose(22, 120), prose(23, 40)
    texts = {i: edited(base, 700 + i, 1 + i % 9) for i in range(90)}
    texts |= {200 + i: edited(other, 800 + i, i % 12) for i in range(50)}
    texts |= {400 + i: prose(950 + i, 60 + i) + " " + passage for i in range(60)}
    return texts


@pytest.mark.parametrize("common", [collide.COMMON, 2])
def test_lacking_shingles_are_written_once_and_in_part(llm, monkeypatch, common):
    written = {}

    def kept(df, label, materialize=collide.materialize):
        written[label] = materialize(df, label)
        return written[label]

    monkeypatch.setattr(collide, "materialize", kept)
    monkeypatch.setattr(collide, "COMMON", common)
    texts = crowds()
    docs = llm.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = near_duplicates(docs, shingle=4).collect()
    assert {r.doc_id: r.component_id for r in rows} == brute_components(texts, 4)
    ahead = collections.Counter((r.a, r.node) for r in written["ahead"].collect())
    sizes = {i: len(shingles(t, 4)) for i, t in texts.items()}
    assert ahead and all(n <= sizes[node] // 5 + 1 for (_, node), n in ahead.items())
    # Before, each of the lists that near copies share had a pivot of its own.
    pivots = collections.defaultdict(set)
    for a, b in written["pairs"].collect():
        pivots[b // 200].add(a)
    assert len(pivots[0]) <= 4


def test_a_pivot_off_the_centre_of_its_group_is_replaced(llm, monkeypatch):
    base = prose(31, 150).split()

    def changed(i, *places):
        return " ".join(f"z{i}x{k}" if k in places else w for k, w in enumerate(base))

    # The pivot 0 has a change of its own; the odd ones lie near the unchanged text, but not near the pivot.
    texts = {0: changed(0, 75), 1: " ".join(base)}
    texts |= {10 + i: changed(i, 5 + 6 * (i % 23)) for i in range(80)}
    texts |= {101 + 2 * i: changed(100 + i, *(5 + 6 * ((i + 3 * k) % 11) for k in range(4))) for i in range(80)}
    compared = []

    def counted(pairs, texts, with_texts=collide._with_texts):
        compared.append(pairs.count())
        return with_texts(pairs, texts)

    # All meet the pivot, in place of the lists they share.
    monkeypatch.setattr(collide, "pivot_pairs", lambda hits: hits.where("node > 0").selectExpr("0L as a", "node as b").distinct())
    monkeypatch.setattr(collide, "short_pairs", lambda hits, percent: hits.selectExpr("node as a", "node as b").limit(0))
    monkeypatch.setattr(collide, "_with_texts", counted)
    docs = llm.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in near_duplicates(docs, shingle=4).collect()}
    assert found == brute_components(texts, 4) == dict.fromkeys(texts, 0)
    # Before, every odd one with all others: about 9,000 pairs.
    assert sum(compared) < 4 * len(texts)


def test_near_duplicates_of_awkward_rows(awkward, no_documents):
    rows = near_duplicates(awkward).collect()
    assert len(rows) == len(AWKWARD)
    by_id = collections.defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append((r.n_shingles, r.component_id, r.kept))
    assert by_id[1] == by_id[2][:0] + [(0, 1, True)] and by_id[2] == [(0, 2, True)] and by_id[3] == [(0, 3, True)]
    assert by_id[4] == [(1, 4, True)] * 2
    assert sorted(by_id[None]) == [(0, None, True), (4, None, True)]
    assert by_id[5] == [(1, 5, True)] and by_id[6] == [(1, 6, True)]
    assert near_duplicates(no_documents).collect() == []


def test_rows_that_repeat_an_id_join_their_texts(llm):
    a, b = prose(1, 60), prose(2, 60)
    docs = llm.createDataFrame([(1, a), (2, a), (2, b), (3, b), (4, prose(3, 60))], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in near_duplicates(docs).collect()} == {(1, 1), (2, 1), (3, 1), (4, 4)}


def test_one_of_each_keeps_the_smallest_id_and_rows_without_id(llm, awkward):
    left = one_of_each(awkward)
    assert left.columns == awkward.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == ["1", "2", "3", "4", "5", "6", "None", "None"]
    text = prose(1, 50)
    docs = llm.createDataFrame([(7, text), (5, text), (9, edited(text, 1, 1))], "doc_id long, text string")
    assert [r.doc_id for r in one_of_each(docs).collect()] == [5]


def test_one_of_each_writes_lacking_shingles_in_part(llm, monkeypatch):
    written = {}

    def kept(df, label, materialize=collide.materialize):
        written[label] = materialize(df, label)
        return written[label]

    monkeypatch.setattr(collide, "materialize", kept)
    texts = crowds()
    docs = llm.createDataFrame(list(texts.items()), "doc_id long, text string")
    left = {r.doc_id for r in one_of_each(docs, shingle=5, percent=80).collect()}
    assert left == {i for i, c in brute_components(texts, 5).items() if i == c}
    whole = written["lacking"].agg(F.sum(F.size("lacking"))).first()[0]
    assert 0 < written["ahead"].count() < whole


def test_components_of_a_path_a_star_and_loops(llm):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 30)] + [(50, 50)]
    found = dict(components(llm.createDataFrame(edges, "a long, b long")).collect())
    assert found == {i: 100 for i in range(100, 141)} | {7: 7} | {i: 7 for i in range(8, 30)}
    assert components(llm.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("run", [1 << 16, 64, 7])
def test_edges_are_contracted_in_runs(llm, monkeypatch, run):
    written = []

    def counted(df, label, materialize=rounds.materialize):
        written.append(label)
        return materialize(df, label)

    monkeypatch.setattr(rounds, "materialize", counted)
    monkeypatch.setattr(rounds, "RUN", run, raising=False)
    # A path from the middle to both ends, a star around its largest node, pairs, loops and repeats.
    edges = [(i, i + 2) for i in range(0, 60, 2)] + [(i, i + 2) for i in range(1, 60, 2)] + [(0, 1)]
    edges += [(900, i) for i in range(800, 850)] + [(5, 5), (7, 9), (9, 7), (None, 3), (-4, -9)]
    found = components(llm.createDataFrame(edges, "a long, b long").repartition(4)).collect()
    named = {i: 0 for i in range(62)} | {i: 800 for i in [*range(800, 850), 900]} | {-4: -9, -9: -9}
    assert len(found) == len(named) and dict(found) == named
    # Before, every call had its rounds of joins, and one more to see that nothing changes.
    if run > len(edges):
        assert len(written) <= 2


def test_words_do_not_depend_on_blocks():
    text = ("héllo wörld \t" * 200_000).encode()
    pieces = hashing.text_words(text)[0]
    assert len(pieces) == 400_000 and len(set(pieces.tolist())) == 2
    runs = list(hashing.batch_words([b"a b", None, text, b"", b"c"]))
    assert [c for _, _, counts in runs for c in counts.tolist()] == [2, 0, 400_000, 0, 1]


@pytest.fixture(scope="module")
def planted(llm):
    passage, other = prose(5, 60), prose(6, 55)
    rows = [
        (1, prose(11, 80) + " " + passage + " " + prose(12, 40)),
        (2, "Ein Anfang.\n" + passage + "\n" + prose(13, 30)),
        (3, prose(14, 33) + "\n" + edited(passage, 3, 1)),
        (4, prose(15, 100)),
        (5, other + "\n" + other),
        (6, prose(16, 20) + " short phrase of nine words that many do share."),
        (7, prose(17, 20) + " short phrase of nine words that many do share."),
    ]
    return llm.createDataFrame(rows, "doc_id long, text string")


def test_repeated_passages_are_found_inside_other_text(planted):
    found = repeated_paragraphs(planted)
    rows = found.collect()
    # 4 is clean, 5 repeats only itself, 6 and 7 share a stock phrase.
    assert {r.doc_id for r in rows} == {1, 2, 3}
    texts = dict(planted.collect())
    inside = set(prose(5, 60).split())
    for r in rows:
        cut = texts[r.doc_id][r.start : r.end].split()
        assert len(cut) == r.words and len(inside & set(cut)) >= 0.7 * len(cut)
    for c in {r.component_id for r in rows}:
        group = [r for r in rows if r.component_id == c]
        first = min((r.doc_id, r.start) for r in group)
        assert sum(r.kept for r in group) == 1
        assert all((r.keep_doc_id, r.keep_start) == first for r in group)


def short_sentences(seed, n):
    """``n`` invented words in sentences of 3 to 15 words."""
    rng, out = random.Random(seed), []
    while len(out) < n:
        sentence = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 8))) for _ in range(rng.randint(3, 15))]
        sentence[-1] += "."
        out += sentence
    return " ".join(out[:n])


@pytest.mark.parametrize(
    "make",
    [
        lambda s, n: " ".join(w.replace(".", "") + "." * (i % 13 == 12) for i, w in enumerate(prose(s, n).split())),
        short_sentences,
        lambda s, n: prose(s, n).replace(".", ""),
        lambda s, n: prose(s, n).replace(".", ".***"),
    ],
    ids=["thirteen words", "three to fifteen words", "no sentences", "marks behind the stop"],
)
def test_passages_of_any_sentences_are_found_in_the_middle_of_a_line(llm, make):
    rows, passages = [], {}
    for k in range(25):
        passages[k] = make(1000 + k, 51 + k)
        for copy in range(2):
            around = [make(5000 + 10 * k + 5 * copy + side, 23 + 9 * copy + k) for side in range(2)]
            rows.append((2 * k + copy, f"{around[0]} {passages[k]} {around[1]}"))
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    found = repeated_paragraphs(docs)
    covered = collections.defaultdict(set)
    for r in found.collect():
        covered[r.doc_id] |= set(range(r.start, r.end))
    left = {r.doc_id: r.text for r in without_repeats(docs, found).collect()}
    for i, text in rows:
        at = text.index(passages[i // 2])
        inside = set(range(at, at + len(passages[i // 2])))
        assert len(covered[i] & inside) > 0.4 * len(inside) and len(covered[i] - inside) < 0.25 * len(inside)
        # The first copy stays whole, the second loses what was found.
        assert left[i] == (text if i % 2 == 0 else "".join(c for at, c in enumerate(text) if at not in covered[i]))


def test_a_text_that_repeats_itself_keeps_one_copy(llm):
    docs = llm.createDataFrame([(1, "la li lu " * 40), (2, "la li lu " * 40)], "doc_id long, text string")
    found = repeated_paragraphs(docs)
    left = {r.doc_id: r.text.split() for r in without_repeats(docs, found).collect()}
    assert len(left[1]) >= 13 and len(left[2]) < 60


def test_paragraph_clusters_equal_brute_force(llm):
    rows = [(i, edited(prose(i % 7, 20), i, i % 3)) for i in range(70)]
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    found = repeated_paragraphs(docs, min_words=5, min_span=5, shingle=2).collect()
    # One sentence of 13 to 20 words and a rest, so paragraphs are cut by hand here.
    units = {}
    for i, text in rows:
        w, start = text.split(" "), 0
        for at, word in enumerate(w):
            if word.endswith(".") and at + 1 - start >= 12 or at == len(w) - 1:
                if at + 1 - start >= 5:
                    units[len(units)] = (i, " ".join(w[start : at + 1]))
                start = at + 1
    expected = collections.defaultdict(set)
    for k, c in brute_components({k: t for k, (_, t) in units.items()}, 2).items():
        expected[c].add(k)
    expected = {frozenset((units[k][0], units[k][1]) for k in g) for g in expected.values()}
    expected = {g for g in expected if len({i for i, _ in g}) > 1}
    got = collections.defaultdict(set)
    text = dict(rows)
    for r in found:
        got[r.component_id].add((r.doc_id, text[r.doc_id][r.start : r.end]))
    # Banding may miss a link at the threshold; here clusters hang together by many.
    assert {frozenset(g) for g in got.values()} == expected


def test_texts_cut_together_have_the_units_of_each_alone(llm):
    texts = [prose(i, 5 + 7 * i) for i in range(12)] + ["", "la li lu " * 40, " \n", prose(40, 24), prose(41, 25)]
    alone, at, until, joined = [], 0, [], []
    for text in texts:
        one = hashing.text_words(text.encode())[0]
        places, hashes = paragraphs.windows(one, np.array([len(one)]))
        alone += zip((places + at).tolist(), hashes.tolist(), strict=True)
        at += len(one)
        until.append(at)
        joined.append(one)
    together = paragraphs.windows(np.concatenate(joined), np.array(until))
    assert alone and list(zip(*(x.tolist() for x in together), strict=True)) == alone

    rows = [(i, t) for i, t in enumerate(texts)]
    docs = llm.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = paragraphs.units(docs, "doc_id", "text", 5, 16).collect()
    # A window is a number; only paragraphs have a digest and tokens.
    assert sorted((r.doc_id, r["first"]) for r in found if r.mark is not None) == sorted(
        (i, place - until[i] + len(joined[i])) for place, _ in alone for i in [np.searchsorted(until, place, "right")]
    )
    for r in found:
        cut = texts[r.doc_id][r.start : r.end]
        assert words(cut) == words(texts[r.doc_id])[r["first"] : r["first"] + r.words]
        assert (r.mark is None) == (r.digest is not None) == (r.tokens is not None)
        assert r.mark is not None or r.size == len(shingles(cut, 5))


def test_cutting_repeats_leaves_the_first_copy(planted):
    left = {r.doc_id: r.text for r in without_repeats(planted, repeated_paragraphs(planted)).collect()}
    texts = dict(planted.collect())
    assert {i for i in texts if left[i] != texts[i]} <= {2, 3} and left[1] == texts[1]
    assert len(left[2].split()) < len(texts[2].split()) - 25


def test_paragraphs_of_awkward_rows(awkward, no_documents):
    found = repeated_paragraphs(awkward)
    assert found.collect() == []
    left = without_repeats(awkward, found)
    assert left.columns == awkward.columns and left.exceptAll(awkward).count() == 0 == awkward.exceptAll(left).count()
    assert repeated_paragraphs(no_documents).collect() == []


def expected_exact(rows):
    groups = collections.defaultdict(list)
    for i, t, *_ in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), sha) for i in ids]
    return sorted(out, key=repr)


def collisions(text):
    return F.substring(F.md5(text), 1, 1)


@pytest.mark.parametrize("digest", [None, collisions])
def test_exact_duplicates_of_awkward_rows(llm, awkward, digest):
    path = scratch_path(llm, "in")
    awkward.repartition(3).write.parquet(path)
    more = {"digest": digest} if digest else {}
    rows = exact_duplicates(llm, path, scratch_path(llm, "state"), **more).collect()
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=repr)
    assert got == expected_exact(AWKWARD)
    # One row of each group stays, also of equal rows.
    assert sum(r.kept for r in rows) == len({r.text_sha256 for r in rows})
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)


def test_state_goes_on_with_files_that_arrive_later(llm):
    path, state = scratch_path(llm, "in"), scratch_path(llm, "state")
    first, second = [(1, "A b"), (2, "x")], [(7, "a B"), (8, "new"), (3, None)]
    llm.createDataFrame(first, "doc_id long, text string").write.parquet(path)
    assert {(r.doc_id, r.keep_id, r.kept) for r in exact_duplicates(llm, path, state).collect()} == {
        (1, 1, True), (2, 2, True),
    }
    llm.createDataFrame(second, "doc_id long, text string").write.mode("append").parquet(path)
    rows = exact_duplicates(llm, path, state).collect()
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=repr)
    assert got == expected_exact(first + second)


def test_exact_duplicates_of_an_empty_table(llm, no_documents):
    path = scratch_path(llm, "in")
    no_documents.write.parquet(path)
    assert exact_duplicates(llm, path, scratch_path(llm, "state")).collect() == []
    assert DOCUMENTS.startswith("doc_id")


def exchanged(n):
    """Two words of ``n`` letters, one with a and b exchanged at every place; polynomials modulo 2**64 cannot tell them apart."""
    first = "".join("ab"[i.bit_count() % 2] for i in range(n))
    return first, first.translate(str.maketrans("ab", "ba"))


def test_words_with_exchanged_letters_have_hashes_of_their_own(llm):
    for n in (2, 64, 65, 1024, 4096):
        a, b = exchanged(n)
        found = hashing.text_words(f"{a} {b} {a}".encode())[0]
        assert found[0] == found[2] != found[1]
    a, b = exchanged(1024)
    docs = llm.createDataFrame([(1, a), (2, b), (3, a)], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_duplicates(docs, 4).collect()} == {1: 1, 2: 2, 3: 1}
    # Whatever the place in a block, a word has one hash.
    long = ("x" * 70 + " ") * 40_000
    assert len(set(hashing.text_words(long.encode())[0].tolist())) == 1
