"""Digests and deterministic identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c


def digest(content, algorithm: str = "sha512") -> Column:
    """Lower-case hex digest with md5, sha256 or sha512."""
    c = _c(content)
    if algorithm == "md5":
        return F.md5(c)
    return F.sha2(c, int(algorithm.removeprefix("sha")))


def digest_like(content, expected) -> Column:
    """Digest of ``content`` by the algorithm the expected hex length implies."""
    n = F.length(_c(expected))
    return (
        F.when(n == 32, digest(content, "md5"))
        .when(n == 64, digest(content, "sha256"))
        .when(n == 128, digest(content, "sha512"))
    )


def stable_id(*parts) -> Column:
    """Content-derived identifier, equal on every run."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(_c(p).cast("string"), F.lit("~")) for p in parts]), 256)
