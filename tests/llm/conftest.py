from __future__ import annotations

import random
import re
import string

import pytest

from silverlode.llm.common import prepare

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


@pytest.fixture(scope="session")
def llm(spark):
    """The session with the operators' settings."""
    return prepare(spark)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def prose(seed: int, n: int) -> str:
    """``n`` invented words in sentences."""
    rng = random.Random(seed)
    out = []
    while len(out) < n:
        sentence = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(rng.randint(13, 20))]
        sentence[-1] += "."
        out += sentence
    return " ".join(out[:n])


def edited(text: str, seed: int, changes: int) -> str:
    rng = random.Random(seed)
    out = text.split(" ")
    for at in rng.sample(range(len(out)), changes):
        out[at] = f"new{seed}x{at}"
    return " ".join(out)


# Null, empty, wordless and non-ASCII texts, repeated rows, a null id, one long word,
# a text of several blocks.
AWKWARD = [
    (1, None, "en", "s", 0),
    (2, "", None, None, None),
    (3, " \n\t ", "en", "s", 3),
    (4, "ÀÉ İstanbul ẞ Σ", "de", "s", 5),
    (4, "ÀÉ İstanbul ẞ Σ", "de", "s", 5),
    (None, "a row without an id, of some words", "en", None, 1),
    (None, None, None, None, None),
    (5, "x" * 70_000, "en", "t", 70_000),
    (6, "word " * 300_000, "en", "t", 1_500_000),
]
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use inside.
CLASHING = ["node", "digest", "component", "label", "score", "size", "key", "host", "token", "_keys", "c0", "bytes"]


@pytest.fixture(scope="session")
def awkward(llm):
    """Awkward documents with extra columns of clashing names."""
    rows = [(*r, *["extra"] * len(CLASHING)) for r in AWKWARD]
    return llm.createDataFrame(rows, DOCUMENTS + "".join(f", {c} string" for c in CLASHING))


@pytest.fixture(scope="session")
def no_documents(llm):
    return llm.createDataFrame([], DOCUMENTS)
