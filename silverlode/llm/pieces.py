"""SentencePiece models encoded and decoded by the tokenizers library.

The model's protobuf is parsed here: pieces with scores and types, the trainer's
algorithm and byte fallback, the normaliser's rule table and white-space flags.  From
them a ``Tokenizer`` is rebuilt: precompiled normaliser, metaspace marker, unigram
scores or BPE merges ranked by score, and byte fallback.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

# Fixed values of the model format: algorithms and piece types.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MARK = "▁"


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    algorithm: int = UNIGRAM
    byte_fallback: bool = False
    unk_id: int = 0
    rules: bytes = b""
    dummy_prefix: bool = True
    remove_extra_spaces: bool = True
    escape_spaces: bool = True


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of every field of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, data[at : at + size]
        at += size


def parse_model(data: bytes) -> Model:
    """A model from the bytes of its file."""
    model = Model()
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            model.pieces.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
            model.algorithm = trainer.get(3, UNIGRAM)
            model.byte_fallback = bool(trainer.get(35, 0))
            model.unk_id = trainer.get(40, 0)
        elif number == 3:
            rules = dict(_fields(value))
            model.rules = rules.get(2, b"")
            model.dummy_prefix = bool(rules.get(3, 1))
            model.remove_extra_spaces = bool(rules.get(4, 1))
            model.escape_spaces = bool(rules.get(5, 1))
    if model.algorithm not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are supported")
    if not model.escape_spaces:
        raise ValueError("models without the space marker are not supported")
    return model


def _merges(model: Model) -> list[tuple[str, str]]:
    """Pairs of pieces that make a piece, best score of the result first."""
    rank = {text: (-score, i) for i, (text, score, kind) in enumerate(model.pieces) if kind in (NORMAL, USER_DEFINED)}
    found = []
    for text, order in rank.items():
        for cut in range(1, len(text)):
            left, right = text[:cut], text[cut:]
            if left in rank and right in rank:
                found.append((order, rank[left][1], rank[right][1], left, right))
    found.sort(key=lambda x: x[:3])
    return [(left, right) for *_, left, right in found]


def splits_at_spaces(model: Model) -> bool:
    """Whether no piece holds a marker behind another character.

    Then no piece can reach across the start of a run of spaces, and a text's units
    (spaces and the word behind them) are encoded alone with the same result.
    """
    return not any(MARK in text.lstrip(MARK) for text, _, kind in model.pieces if kind in (NORMAL, USER_DEFINED))


def build(model: Model) -> Tokenizer:
    """The model as a ``tokenizers.Tokenizer``."""
    vocab = [(text, score) for text, score, _ in model.pieces]
    if model.algorithm == UNIGRAM:
        inner = models.Unigram(vocab, unk_id=model.unk_id, byte_fallback=model.byte_fallback)
    else:
        ids = {text: i for i, (text, _) in enumerate(vocab)}
        unknown = vocab[model.unk_id][0]
        inner = models.BPE(ids, _merges(model), unk_token=unknown, fuse_unk=True, byte_fallback=model.byte_fallback)
    tokenizer = Tokenizer(inner)
    steps = []
    if model.rules:
        steps.append(normalizers.Precompiled(model.rules))
    if model.remove_extra_spaces:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        # Not before an empty text, which has no pieces.
        steps.append(normalizers.Replace(Regex(r"\A(?=[\s\S])"), " "))
    steps.append(normalizers.Replace(" ", MARK))
    tokenizer.normalizer = normalizers.Sequence(steps)
    if splits_at_spaces(model):
        unit = Regex(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        tokenizer.pre_tokenizer = pre_tokenizers.Split(unit, "isolated")
    undo = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix:
        undo.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(undo)
    defined = [AddedToken(text, normalized=False) for text, _, kind in model.pieces if kind == USER_DEFINED]
    if defined:
        tokenizer.add_tokens(defined)
    return tokenizer


def normalized(model: Model, text: str) -> str:
    """The text that decoding gives back, for a model without a rule table."""
    if model.remove_extra_spaces:
        text = " ".join(x for x in text.split(" ") if x)
    # A marker in the text is not told from a space.
    return text.replace(MARK, " ")


class Encoder:
    """Token ids of texts, encoding every distinct unit of a batch once.

    A unit is a run of markers with the characters behind it.  Where pieces cannot
    reach over the start of a unit, a text's ids are its units' ids in order; else
    the whole text is the only unit.  Units of earlier batches are remembered, up to
    ``REMEMBERED``.
    """

    REMEMBERED = 300_000
    JOINED = 100

    def __init__(self, model: Model):
        self.model = model
        self.whole = build(model)
        self.units = build(model)
        self.units.normalizer = self.units.pre_tokenizer = None
        marker = any(text == MARK for text, _, kind in model.pieces if kind == NORMAL)
        plain = all(kind != USER_DEFINED for *_, kind in model.pieces)
        self.by_unit = marker and plain and splits_at_spaces(model)
        self.opens = np.array([text.startswith(MARK) for text, *_ in model.pieces])
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.starts = np.zeros(1, np.int64)
        self.flat = np.empty(0, np.int32)

    def _normal(self, text: str) -> str:
        return self.whole.normalizer.normalize_str(text) if self.model.rules else self._marked(text)

    def _split(self, marked: str) -> list[str]:
        if not self.by_unit:
            return [marked] if marked else []
        if not marked.startswith(MARK) or MARK * 2 in marked or marked.endswith(MARK):
            return re.findall(f"{MARK}+[^{MARK}]*|[^{MARK}]+", marked)
        # The usual case: one marker before every unit, named by a space.
        return marked.replace(MARK, MARK + " ")[1:].split(MARK)

    def _marked(self, text: str) -> str:
        text = normalized(self.model, text)
        if text and self.model.dummy_prefix:
            text = " " + text
        return text.replace(" ", MARK)

    def _learn(self, new: list[str]) -> None:
        """Encode the units ``new``, many at a time where their ids can be told apart."""
        single = [u for u in new if u[0] == " "]
        joined = ["".join(single[i : i + self.JOINED]) for i in range(0, len(single), self.JOINED)]
        others = [u for u in new if u[0] != " "]
        marked = [u.replace(" ", MARK) for u in joined + others]
        ids = [np.array(e.ids, np.int32) for e in self.units.encode_batch_fast(marked, add_special_tokens=False)]
        flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
        # Exactly the first piece of a unit with one marker starts with it.
        in_joined = sum(map(len, ids[: len(joined)]))
        begins = np.concatenate((np.flatnonzero(self.opens[flat[:in_joined]]), [in_joined]))
        lengths = np.concatenate((np.diff(begins), [len(x) for x in ids[len(joined) :]])).astype(np.int64)
        first = len(self.place)
        self.place.update(zip(single + others, range(first, first + len(new)), strict=True))
        self.starts = np.concatenate((self.starts, self.starts[-1] + np.cumsum(lengths)))
        self.flat = np.concatenate((self.flat, flat))

    def _returns(self, marked: list[str], ids: list[np.ndarray]) -> np.ndarray:
        """Whether the ids of each whole text, decoded as ``decoded`` does, give it back."""
        back = self.whole.decode_batch([x.tolist() for x in ids], skip_special_tokens=False)
        prefix = " " if self.model.dummy_prefix else ""
        return np.array([b == m.replace(MARK, " ").removeprefix(prefix) for m, b in zip(marked, back, strict=True)], bool)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids in a row, ids per text, and whether decoding gives each text back."""
        if len(self.place) > self.REMEMBERED:
            self._forget()
        marked = [self._normal(t) for t in texts]
        split = [self._split(m) for m in marked]
        new = list(dict.fromkeys(u for units in split for u in units if u not in self.place))
        if new:
            self._learn(new)
        counts = np.fromiter(map(len, split), np.int64, len(split))
        places = np.fromiter(map(self.place.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
        begin, size = self.starts[places], np.diff(self.starts)[places]
        done = np.cumsum(size)
        at = np.arange(done[-1] if len(done) else 0) + np.repeat(begin - (done - size), size)
        ends = np.concatenate(([0], done))[np.cumsum(counts)]
        flat, sizes = self.flat[at], np.diff(ends, prepend=0)
        return flat, sizes, self._returns(marked, np.split(flat, ends[:-1]) if texts else [])


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encoded(
    docs: DataFrame, model_bytes: bytes, keep: list[str], text_column: str = "text", threads: int = 2
) -> DataFrame:
    """Columns ``keep`` of ``docs``, the token ids of every whole text and its round trip.

    Adds ``ids`` (array of int), ``n_tokens`` and ``round_trip``: whether decoding the
    ids gives the text as the model normalises it.  Batches are encoded by
    ``threads`` threads a task; give tasks as many cores.

    * Null and empty texts have no ids; they round-trip.
    * Texts with characters outside the vocabulary use byte fallback where the model
      has it; else they yield the unknown id and do not round-trip.
    * Strings that look like control pieces are ordinary text.
    * Repeated rows are encoded alike; columns that are not in ``keep`` are not read,
      apart from the text.  An empty table gives an empty result.

    The model is a file of bounded size (a vocabulary); its bytes go with the tasks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model_bytes)
    inner = [f"c{i}" for i in range(len(keep))]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        encoder = Encoder(parse_model(shared.value))
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = [t or "" for t in batch.column(len(inner)).to_pylist()]
                flat, counts, same = encoder.encode(texts)
                offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                columns = [ids, pa.array(counts), pa.array(same)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], *columns], names=[*inner, "ids", "n_tokens", "round_trip"]
                )

    kept = docs.select(
        *[F.col(f"`{k}`").alias(i) for k, i in zip(keep, inner, strict=True)],
        F.col(f"`{text_column}`").cast("string").alias("text"),
    )
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    schema = f"{fields}, ids array<int>, n_tokens long, round_trip boolean".lstrip(", ")
    return kept.mapInArrow(work, schema).toDF(*keep, "ids", "n_tokens", "round_trip")


def decoded(tokens: DataFrame, model_bytes: bytes, keep: list[str], ids_column: str = "ids") -> DataFrame:
    """Columns ``keep`` and the text of the token ids; null ids give an empty text."""
    shared = tokens.sparkSession.sparkContext.broadcast(model_bytes)
    inner = [f"c{i}" for i in range(len(keep))]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = build(parse_model(shared.value))
        for batch in batches:
            texts = tokenizer.decode_batch([x or [] for x in batch.column(len(inner)).to_pylist()], skip_special_tokens=False)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*inner, "text"])

    kept = tokens.select(
        *[F.col(f"`{k}`").alias(i) for k, i in zip(keep, inner, strict=True)],
        F.col(f"`{ids_column}`").cast("array<int>").alias("ids"),
    )
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    return kept.mapInArrow(work, f"{fields}, text string".lstrip(", ")).toDF(*keep, "text")


def parity(docs: DataFrame, model_bytes: bytes, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(doc_id, same)``: whether the rebuilt tokenizer gives every text the ids of the
    sentencepiece library.  Encodes twice; for checks of a model, not for production."""
    shared = docs.sparkSession.sparkContext.broadcast(model_bytes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        ours = Encoder(parse_model(shared.value))
        theirs = sentencepiece.SentencePieceProcessor(model_proto=shared.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            flat, counts, _ = ours.encode(texts)
            mine = np.split(flat, np.cumsum(counts)[:-1])
            same = [m.tolist() == t for m, t in zip(mine, theirs.encode(texts, num_threads=1), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(same)], names=["doc_id", "same"])

    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(work, "doc_id long, same boolean")
