"""Hashes of words, word n-grams and shingle sets, vectorised over a batch of texts.

Texts come as UTF-8 bytes.  A word's hash depends on its bytes alone, so long texts
are hashed in blocks cut at white space and memory stays bounded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np

BLOCK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# Tables of the process.  Plain dictionaries, since cached functions would be
# pickled by name and the executors need no copy of this package.
_tables: dict = {}


def constants(n: int, salt: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers."""
    if (n, salt) not in _tables:
        seeds = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(salt)
        _tables[n, salt] = mix(seeds) | np.uint64(1)
    return _tables[n, salt]


# Places in a word that have a table of their own; later ones are mixed with their block.
PLACES = 64


def _letters() -> np.ndarray:
    """A random 64-bit value per place in a word and byte, flat."""
    if "letters" not in _tables:
        _tables["letters"] = mix(constants(PLACES * 256, 77))
    return _tables["letters"]


def _is_space() -> np.ndarray:
    if "space" not in _tables:
        _tables["space"] = np.zeros(256, bool)
        _tables["space"][[32, 9, 10, 11, 12, 13]] = True
    return _tables["space"]


def _hash_block(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every word of ``data``.

    A word's hash is the mixed sum of values drawn for each place and byte, so no
    structure of words makes them collide; a polynomial modulo 2**64 would let words
    of a thousand letters meet by exchanging two letters.
    """
    codes = np.frombuffer(data, dtype=np.uint8)
    inside = ~_is_space()[codes]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), starts, ends
    sizes = ends - starts
    firsts = np.cumsum(sizes) - sizes
    place = np.arange(firsts[-1] + sizes[-1]) - np.repeat(firsts, sizes)
    values = _letters()[(place % PLACES << 8) | codes[inside]]
    if sizes.max() > PLACES:
        far = np.flatnonzero(place >= PLACES)
        values[far] = mix(values[far] + (place[far] // PLACES).astype(np.uint64) * np.uint64(_BASE))
    return mix(np.add.reduceat(values, firsts) + sizes.astype(np.uint64)), starts, ends


def _pieces(text: bytes) -> Iterator[bytes]:
    """Blocks of one long text, cut behind white space."""
    at = 0
    while len(text) - at > BLOCK_BYTES:
        cut = at + BLOCK_BYTES
        while cut < len(text) and text[cut] not in b" \t\n\v\f\r":
            cut += 1
        yield text[at:cut]
        at = cut
    yield text[at:]


def text_words(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends (byte offsets) of the words of one text."""
    if len(text) <= BLOCK_BYTES:
        return _hash_block(text)
    parts, at = [], 0
    for piece in _pieces(text):
        hashes, starts, ends = _hash_block(piece)
        parts.append((hashes, starts + at, ends + at))
        at += len(piece)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def batch_words(texts: Sequence[bytes | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, all word hashes, words per text) for runs of texts.

    Null counts as empty.  Short texts share a block; a long one makes its own run.
    """
    run: list[bytes] = []
    first, size = 0, 0

    def flush():
        joined = b"\n".join(run)
        hashes, starts, _ = _hash_block(joined)
        begins = np.cumsum([0] + [len(t) + 1 for t in run])
        return first, hashes, np.diff(np.searchsorted(starts, begins))

    for i, text in enumerate(texts):
        text = text or b""
        if len(text) > BLOCK_BYTES:
            if run:
                yield flush()
            hashes = text_words(text)[0]
            yield i, hashes, np.array([len(hashes)])
            run, first, size = [], i + 1, 0
            continue
        run.append(text)
        size += len(text)
        if size >= BLOCK_BYTES:
            yield flush()
            run, first, size = [], i + 1, 0
    if run:
        yield flush()


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; fewer words make one shingle, none make none."""
    if not len(words):
        return np.empty(0, np.uint64)
    size = min(size, len(words))
    factors = constants(size, 1000 + size)
    total = np.zeros(len(words) - size + 1, np.uint64)
    for j in range(size):
        total += words[j : len(words) - size + 1 + j] * factors[j]
    return mix(total)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    keep = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    return values[keep]


def shingle_sets(texts: Sequence[bytes | None], size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingles of each text, in order; A-Z are lower-cased."""
    for _, hashes, counts in batch_words([t.lower() if t else t for t in texts]):
        ends = np.cumsum(counts)
        for begin, end in zip(ends - counts, ends, strict=True):
            yield distinct(shingle_hashes(hashes[begin:end], size))


def digest(values: np.ndarray) -> bytes:
    """128-bit digest of a sorted set of hashes."""
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def least(values: np.ndarray, starts: np.ndarray, coordinates: int) -> np.ndarray:
    """MinHash signatures of the non-empty sets that begin at ``starts``, one row each, as 32-bit values."""
    out = np.empty((len(starts), coordinates), np.uint32)
    for k, factor in enumerate(constants(coordinates, 31)):
        out[:, k] = np.minimum.reduceat((values * factor) >> np.uint64(32), starts)
    return out


def signatures(sets: Sequence[np.ndarray], coordinates: int) -> np.ndarray:
    """MinHash signatures of non-empty sets, one row each, as 32-bit values."""
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    return least(np.concatenate(sets), starts, coordinates)


def low_bits(signature: np.ndarray) -> np.ndarray:
    """The lowest bits of 64 coordinates as one 64-bit value per row."""
    return np.packbits((signature[:, :64] & 1).astype(np.uint8), axis=1, bitorder="little").view(np.int64).ravel()


def contained(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which elements of ``a`` lie in ``b``, both sorted and distinct."""
    if not len(b):
        return np.zeros(len(a), bool)
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return b[at] == a
