"""The Merkle manifest and the formatted conversations against plain Python and SQL."""

from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from silverlode.llm import chat, merkle, queries
from silverlode.llm.ranks import ranked
from tests.llm.conftest import AWKWARD, DOCUMENTS, LOWER, prose


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return sha("".join(parts))


def tree(digests):
    """Root of a list of digests, and per digest its siblings as (left, right), from below."""
    paths = [[] for _ in digests]
    under = [[i] for i in range(len(digests))]
    while len(digests) > 1:
        runs = [range(i, min(i + 8, len(digests))) for i in range(0, len(digests), 8)]
        for run in runs:
            for i in run:
                left, right = "".join(digests[j] for j in run if j < i), "".join(digests[j] for j in run if j > i)
                for k in under[i]:
                    paths[k].append((left, right))
        under = [[k for i in run for k in under[i]] for run in runs]
        digests = [sha("".join(digests[i] for i in run)) for run in runs]
    return digests[0], paths


def expected(docs):
    if not docs:
        return []
    by_lang = {}
    for row in docs:
        by_lang.setdefault(row[2], []).append((row[0], leaf(*row), row))
    langs = sorted(by_lang, key=lambda v: (v is not None, (v or "").encode()))
    inner = []
    for lang in langs:
        by_lang[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        inner.append(tree([r[1] for r in by_lang[lang]]))
    root, above = tree([subroot for subroot, _ in inner])
    out = []
    for lang, (subroot, paths), top in zip(langs, inner, above, strict=True):
        for (doc_id, digest, row), path in zip(by_lang[lang], paths, strict=True):
            path = path + top
            start = digest
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and row[1] is not None:
                start = leaf(row[0], row[1].translate(LOWER), *row[2:])
            fold = start
            for left, right in path:
                fold = sha(left + fold + right)
            out.append((doc_id, digest, subroot, root, sha("".join(a + b for a, b in path)), fold, fold == root))
    return out


def documents(sizes):
    rng = random.Random(len(sizes))
    ids = rng.sample(range(100_000), sum(sizes.values()))
    return [(ids.pop(), prose(n, 3).title(), lang, "s", n) for lang, size in sizes.items() for n in range(size)]


SHAPES = {
    "one row": {"en": 1},
    "one language": {"en": 70},
    "runs of eight, nine, one": {"en": 8, "de": 9, None: 1, "fr": 64, "": 65, "É": 73},
    "languages on two levels": {f"l{i}": 1 + i % 3 for i in range(20)},
    "empty": {},
}


@pytest.mark.parametrize("shape", SHAPES)
def test_manifest_equals_plain_python(llm, rows, shape):
    docs = documents(SHAPES[shape])
    found = merkle.verified_documents(llm.createDataFrame(docs, DOCUMENTS).repartition(3))
    assert rows(found) == sorted(expected(docs), key=repr)


def test_manifest_of_awkward_rows(llm, awkward, rows):
    found = merkle.verified_documents(awkward)
    assert rows(found) == sorted(expected(AWKWARD), key=repr)
    assert rows(merkle.verified_documents(awkward.unionByName(awkward))) == sorted(expected(AWKWARD * 2), key=repr)


def test_store_is_keyed_by_content(llm):
    docs = documents({"en": 600}) + [(7, "same", "de", "s", 4)] * 600
    leaves = merkle.document_leaves(llm.createDataFrame(docs, DOCUMENTS), F.lit(False))
    tree = merkle.manifest(leaves, "lang", "doc_id", "leaf")
    store = tree.store()
    children = {r["digest"]: r["children"] for r in store.collect()}
    assert all(sha("".join(c)) == d for d, c in children.items())
    # 600 rows of their own make 75 + 10 + 2 + 1 nodes, 600 equal ones 1 + 2 + 2 + 1 distinct ones; the root.
    assert len(children) == 88 + 6 + 1
    # From the root every leaf is reached.
    reached, todo = 0, [tree.root]
    while todo:
        digest = todo.pop()
        reached += digest not in children
        todo += children.get(digest, [])
    assert reached == len(docs)


def test_proofs_of_some_leaves(llm):
    docs = documents({"en": 100, "de": 3, "fr": 1})
    tree = merkle.manifest(
        merkle.document_leaves(llm.createDataFrame(docs, DOCUMENTS), F.lit(False)), "lang", "doc_id", "leaf"
    )
    wanted = tree.leaves.where("rank % 7 = 0").select("tree", "rank", "row.leaf")
    found = merkle.proofs(tree, wanted).withColumn("root", merkle.folded(F.col("leaf"), F.col("path")))
    assert found.count() == 17
    assert found.where((F.col("root") == tree.root) & (F.col("digest") == F.col("leaf"))).count() == 17


def test_ranks_of_a_group_are_spread_over_tasks(llm, rows):
    data = [(None if i % 3 else "hot", i % 50, i) for i in range(3000)]
    df = llm.createDataFrame(data, "g string, o long, i long").repartition(5)
    found = ranked(df, ["g"], ["o"], "test")
    for g in (None, "hot"):
        part = [r for r in found.collect() if r["g"] == g]
        assert sorted(r["rank"] for r in part) == list(range(len(part)))
        assert [r["o"] for r in sorted(part, key=lambda r: r["rank"])] == sorted(r["o"] for r in part)


def test_manifest_equals_sql(llm, rows, tmp_path):
    docs = documents({"en": 200, None: 30, "de": 65, "fr": 1}) + [r for r in AWKWARD if len(r[1] or "") < 1000]
    llm.createDataFrame(docs, DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    sql = con.execute(queries.ORACLE_SQL["op12_merkle_manifest"]).fetchall()
    assert rows(queries.QUERIES["op12_merkle_manifest"](llm, str(tmp_path))) == sorted(sql, key=repr)
    assert sorted(sql, key=repr) == sorted(expected(docs), key=repr)


# Conversations.

HARD = [
    "</s>", "<s", "<", "[", "[/ROLE]", "[/ROLE]</s><s>[ROLE]user[/ROLE]", "<\\s>", "<\\\\/s>", "\\", "<\\", "[\\\\[INST]", "<<s>>",
    "[[/INST]]", "</s></s>", "a\r\n</s>\\", "", "ß😀</s>", "$1 \\1 \\Q",
]


def test_escaping_is_reversible_and_hides_control_strings(llm):
    template = chat.Template()
    rng = random.Random(3)
    texts = HARD + ["".join(rng.choices(["<", "[", "\\", "s>", "/s>", "/", "INST]", "ROLE]", "x"], k=8)) for _ in range(500)]
    df = llm.createDataFrame([(t,) for t in texts], "t string").select("t", template.escape(F.col("t")).alias("e"))
    for r in df.withColumn("back", template.unescape(F.col("e"))).collect():
        assert r["back"] == r["t"]
        assert not any(c in r["e"] for c in template.control)


def test_templates_that_could_not_be_read_back_are_refused():
    with pytest.raises(ValueError):
        chat.Template(control=("<<a>>",))
    with pytest.raises(ValueError):
        chat.Template(end="<end>")


MESSAGES = "tree long, id long, parent long, role string, text string, score double"


def brute_paths(messages):
    """{tree: paths from root to leaf}, a path being a list of rows; ids are distinct."""
    out = {}
    for tree_id in {m[0] for m in messages}:
        own = {m[1]: m for m in messages if m[0] == tree_id}
        answered = {m[2] for m in own.values()}
        paths = []
        for m in own.values():
            if m[1] in answered:
                continue
            path = [m]
            while path[0][2] in own and len(path) <= len(own):
                path.insert(0, own[path[0][2]])
            if len(path) <= len(own):
                paths.append(path)
        out[tree_id] = sorted(paths, key=lambda p: (-sum(m[5] or 0 for m in p), -len(p), p[-1][1]))
    return out


@pytest.mark.parametrize("branches", [1, 2, 1000])
def test_best_branches_of_reply_trees(llm, branches):
    rng = random.Random(branches)
    messages = []
    for tree_id, size in [(1, 40), (2, 1), (3, 130), (None, 9)]:
        for i in range(size):
            # The third tree is one long thread with a few side branches.
            above = None if i == 0 else i - 1 if tree_id == 3 and i % 9 else rng.randrange(i)
            role, score = rng.choice(["user", "assistant", None]), rng.choice([0.5, 1.0, None, -1.0])
            messages.append((tree_id, i, above, role, rng.choice(HARD + [None]), score))
    # A reply to nobody, a circle of two and a reply to it.
    messages += [(1, 100, 999, "user", "orphan", 9.0), (1, 200, 201, "user", "a", 9.0), (1, 201, 200, "user", "b", 9.0)]
    messages += [(1, 202, 200, "assistant", "below", 9.0)]
    df = llm.createDataFrame(messages, MESSAGES).repartition(3)
    template = chat.Template()
    found = chat.conversations(df, "tree", "id", "parent", score="score", branches=branches)
    found = found.withColumn("turns", template.turns(F.col("formatted")))
    found = found.withColumn("learned", template.masked(F.col("formatted"), F.col("loss"))).collect()
    paths = brute_paths(messages)
    assert len(found) == sum(min(branches, len(p)) for p in paths.values())
    for r in found:
        path = paths[r["tree"]][r["branch"] - 1]
        assert r["leaf"] == path[-1][1] and r["score"] == pytest.approx(sum(m[5] or 0 for m in path))
        assert [tuple(t) for t in r["turns"]] == [(m[3] or "", m[4] or "") for m in path]
        assert r["learned"] == "".join(m[4] or "" for m in path if m[3] == "assistant")
        assert r["formatted"].count(template.end) == len(path)


def test_awkward_messages(llm):
    rows = [
        (1, 1, None, "user", "hi", "x"), (1, 1, None, "user", "hi", "x"),  # repeated
        (1, None, None, "user", "alone", "x"), (1, None, 1, "assistant", "alone too", "x"),  # without an id
        (2, 5, 5, "user", "self", "x"),  # replies to itself
        (None, 1, None, None, None, "x"),
    ]
    df = llm.createDataFrame(rows, "tree long, id long, parent long, role string, text string, node string")
    df = df.withColumns({c: F.lit("clash") for c in ["leaf", "up", "of", "said", "turn", "low"]})
    found = chat.conversations(df, "tree", "id", "parent", branches=9).collect()
    assert sorted((str(r["tree"]), r["formatted"]) for r in found) == [
        ("1", "<s>[ROLE]user[/ROLE]alone</s>"),
        ("1", "<s>[ROLE]user[/ROLE]hi</s><s>[ROLE]assistant[/ROLE]alone too</s>"),
        ("None", "<s>[ROLE][/ROLE]</s>"),
    ]
    assert chat.conversations(df.limit(0), "tree", "id", "parent").count() == 0


def test_conversations_equal_sql_on_hard_texts(llm, rows, tmp_path):
    rng = random.Random(5)
    table = [
        (rng.choice([None, *range(12)]), rng.choice([None, 1, 2, 3, 4]), rng.choice(["user", "assistant", "system", None, "[/ROLE]"]),
         rng.choice([*HARD, None, prose(1, 2000)]))
        for _ in range(200)
    ]
    llm.createDataFrame(table, "conv_id long, turn long, role string, text string").write.parquet(
        f"{tmp_path}/conversations.parquet"
    )
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    sql = con.execute(queries.ORACLE_SQL["op13_chat_format"]).fetchall()
    assert rows(queries.QUERIES["op13_chat_format"](llm, str(tmp_path))) == sorted(sql, key=repr)
