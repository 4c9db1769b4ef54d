"""The operators applied to their whole tables, as the driver runs them."""

from __future__ import annotations

import importlib.util
import os

from pyspark.sql import functions as F

from silverlode.session import scratch_path

from . import chat, merkle, mixing, site_lines
from .exact_stream import exact_duplicates
from .near_dup import near_duplicates
from .paragraphs import repeated_paragraphs
from .periodic import periodic_runs, planted, run_digests
from .pieces import encoded, read_model
from .registry import ORACLE_SQL, QUERIES, query, table
from .toxicity import toxicity
from .url_reputation import Rule, judge_urls, outcomes_of_copies
from .vectors import nearest
from .weak_quality import quality

__all__ = ["ORACLE_SQL", "QUERIES"]

# The rules and the weights that the queries are asked for.
URL_RULES = [
    Rule("block", "net/"),
    Rule("allow", "example.net/en/"),
    Rule("block", "example.com/de/"),
    Rule("allow", "org/fr/"),
]
SOURCE_WEIGHTS = (5, 2, 1)
BUDGET_SHARE = 1.5
MAX_EPOCHS = 2

# The tables' hosts lie below these names, as if each were a public suffix; besides, the
# general rule for country domains holds.
URL_SUFFIXES = ["example.com", "example.net", "example.org"]


def sentencepiece_model() -> bytes:
    """The model file that ``SENTENCEPIECE_MODEL`` names, else the installed public one."""
    named = os.environ.get("SENTENCEPIECE_MODEL")
    if not named:
        folder = importlib.util.find_spec("public_tokenizers").submodule_search_locations[0]
        named = os.path.join(folder, "piece_bpe_32k.model")
    return read_model(named)


@query("op1_paragraph_minhash")
def op1(spark, sf_dir):
    return repeated_paragraphs(table(spark, sf_dir, "documents"))


OP2_SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g USING (t)
"""


@query("op2_exact_dedup_stream", OP2_SQL)
def op2(spark, sf_dir):
    return exact_duplicates(spark, f"{sf_dir}/documents.parquet", scratch_path(spark, "dedup-state"))


@query("op3_minhash_near_dedup")
def op3(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4, percent=80)


@query("op4_url_reputation")
def op4(spark, sf_dir):
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    return judge_urls(pages, outcomes_of_copies(pages, labels), URL_RULES, URL_SUFFIXES)


@query("op5_sentencepiece")
def op5(spark, sf_dir):
    return encoded(table(spark, sf_dir, "documents"), sentencepiece_model(), ["doc_id"])


@query("op6_weak_quality")
def op6(spark, sf_dir):
    return quality(table(spark, sf_dir, "documents"))


@query("op7_vector_search")
def op7(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@query("op8_source_mixing", mixing.ORACLE)
def op8(spark, sf_dir):
    counts = mixing.mix_counts(table(spark, sf_dir, "documents"), SOURCE_WEIGHTS, BUDGET_SHARE, MAX_EPOCHS)
    return counts.select("doc_id", "size", "source_size", "target", "taken")


@query("op9_toxicity")
def op9(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_site_lines", site_lines.ORACLE)
def op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    cleaned = site_lines.cleaned_lines(docs, F.col("source"))
    return cleaned.withColumnsRenamed({"_lines": "n_lines", "_dropped": "n_dropped"})


@query("op11_periodic_runs")
def op11(spark, sf_dir):
    return run_digests(periodic_runs(planted(table(spark, sf_dir, "documents"))))


@query("op12_merkle_manifest", merkle.ORACLE)
def op12(spark, sf_dir):
    return merkle.verified_documents(table(spark, sf_dir, "documents"))


@query("op13_chat_format", chat.ORACLE)
def op13(spark, sf_dir):
    messages = chat.threads(chat.with_hostile(table(spark, sf_dir, "conversations")))
    return chat.read_back(chat.conversations(messages, "conv_id", "message", "parent"))
