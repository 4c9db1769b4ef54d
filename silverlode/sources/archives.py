"""ZIP archives as DataFrames of members.

The central directories are listed first, in tasks; then the members are spread over
tasks by hash, so that one huge archive does not become one huge task.  A listed member
carries its offset, so it is read without its archive's directory.
"""

from __future__ import annotations

import collections
import hashlib
import io
import math
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.functions import paths

from .files import below, list_files
from .remote import open_read, write_stream

TASK_BYTES = 64 << 20
BATCH_BYTES = 16 << 20
STREAM_BYTES = 1 << 20
ROW_BYTES = 2_000_000_000

# A member with all that is needed to read it without its archive's directory.
MEMBER_SCHEMA = """archive_path string, archive string, member_path string, size_bytes long, offset long, packed_bytes long,
    method int, flags int, crc long, meets boolean"""
LOCAL_HEADER = "<4s22xHH"
STORED, DEFLATED, ENCRYPTED = zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, 1


def target_name(member: str) -> str:
    """The path that a member would have on disk, by which members meet."""
    return "/".join(p for p in member.replace("\\", "/").split("/") if p not in ("", "."))


def _list(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, name in zip(batch["path"], batch["name"], strict=True):
            with open_read(path) as f, zipfile.ZipFile(f) as z:
                infos = [i for i in z.infolist() if not i.is_dir()]
            targets = collections.Counter(target_name(i.filename) for i in infos)
            yield pd.DataFrame(
                {
                    "archive_path": path,
                    "archive": name,
                    "member_path": [i.filename for i in infos],
                    "size_bytes": [i.file_size for i in infos],
                    "offset": [i.header_offset for i in infos],
                    "packed_bytes": [i.compress_size for i in infos],
                    "method": [i.compress_type for i in infos],
                    "flags": [i.flag_bits for i in infos],
                    "crc": [i.CRC for i in infos],
                    "meets": [targets[target_name(i.filename)] > 1 for i in infos],
                }
            )


def list_members(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """One row per member; only the central directories are read, each once.

    ``archive`` is the path below ``path``, so archives of one name in two folders stay
    apart.  ``meets`` marks members that would be one file on disk.
    """
    found = list_files(spark, path, glob).select("path", below(spark, path, F.col("path")).alias("name"))
    return found.mapInPandas(_list, MEMBER_SCHEMA)


def task_count(spark: SparkSession, path: str, glob: str, task_bytes: int) -> int:
    """Enough tasks for the files' total size, at least one per core.

    Work items are tiny rows that stand for large reads, so partitions cannot be
    sized by their bytes; an explicit count also keeps AQE from merging them.
    """
    total = list_files(spark, path, glob).agg(F.sum("size_bytes")).first()[0] or 0
    return max(spark.sparkContext.defaultParallelism, math.ceil(total / task_bytes))


def _spread(spark: SparkSession, path: str, glob: str, wanted: Column | None = None) -> DataFrame:
    """Members spread over enough tasks for the archives' total size; ``wanted`` drops others before any is read."""
    tasks = task_count(spark, path, glob, TASK_BYTES)
    members = list_members(spark, path, glob)
    if wanted is not None:
        members = members.where(wanted)
    return members.repartition(tasks, "archive_path", "member_path").sortWithinPartitions("archive_path", "offset")


class _Member(io.RawIOBase):
    """The content of one member, read by its offset and checked against its CRC."""

    def __init__(self, file, row):
        if row.flags & ENCRYPTED or row.method not in (STORED, DEFLATED):
            raise zipfile.BadZipFile(f"{row.archive}: cannot read {row.member_path} (method {row.method}, flags {row.flags})")
        file.seek(row.offset)
        signature, name, extra = struct.unpack(LOCAL_HEADER, file.read(struct.calcsize(LOCAL_HEADER)))
        if signature != b"PK\x03\x04":
            raise zipfile.BadZipFile(f"{row.archive}: no member at the place of {row.member_path}")
        file.seek(row.offset + struct.calcsize(LOCAL_HEADER) + name + extra)
        self._file, self._row, self._left, self._crc, self._held = file, row, row.packed_bytes, 0, b""
        self._inflate = zlib.decompressobj(-zlib.MAX_WBITS) if row.method == DEFLATED else None

    def readable(self) -> bool:
        return True

    def _packed(self) -> bytes:
        block = self._file.read(min(self._left, STREAM_BYTES))
        self._left -= len(block)
        return block

    def _more(self) -> bytes:
        """The next block; empty at the end, or where the archive ends too early."""
        if not self._inflate:
            return self._packed()
        while not self._inflate.eof:
            packed = self._inflate.unconsumed_tail or self._packed()
            data = self._inflate.decompress(packed, STREAM_BYTES)
            if data or not packed:
                return data
        return b""

    def readinto(self, buffer) -> int:
        if not self._held:
            self._held = self._more()
            self._crc = zlib.crc32(self._held, self._crc)
            if not self._held and self._crc != self._row.crc:
                raise zipfile.BadZipFile(f"{self._row.archive}: bad CRC-32 of {self._row.member_path}")
        n = min(len(buffer), len(self._held))
        buffer[:n], self._held = self._held[:n], self._held[n:]
        return n


def _each_member(batch: pd.DataFrame) -> Iterator[tuple[tuple, object]]:
    """(row, open member stream) per row, opening each archive once and its directory not again."""
    for archive_path, rows in batch.groupby("archive_path", sort=False):
        with open_read(archive_path) as f:
            for row in rows.itertuples(index=False):
                yield row, io.BufferedReader(_Member(f, row), STREAM_BYTES)


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["archive", "member_path", "size_bytes", "content"]
    for batch in batches:
        out, held = [], 0
        for row, stream in _each_member(batch):
            content = stream.read()
            out.append((row.archive, row.member_path, row.size_bytes, content))
            held += len(content)
            if held >= BATCH_BYTES:
                yield pd.DataFrame(out, columns=columns)
                out, held = [], 0
        if out:
            yield pd.DataFrame(out, columns=columns)


def read_members(spark: SparkSession, path: str, glob: str = "*.zip", wanted: Column | None = None) -> DataFrame:
    """(archive, member_path, size_bytes, content) of every member of every archive.

    ``wanted``, a condition on the columns of ``list_members``, keeps others from being
    read.  A member must fit a row (2 GB); larger ones are streamed by the other functions.
    """
    fits = F.col("size_bytes") < ROW_BYTES
    too_large = F.raise_error(F.concat("archive", F.lit(": member does not fit a row: "), "member_path"))
    checked = F.when(fits, True).otherwise(too_large.cast("boolean"))
    return _spread(spark, path, glob, checked if wanted is None else wanted & checked).mapInPandas(
        _read, "archive string, member_path string, size_bytes long, content binary"
    )


def member_digests(spark: SparkSession, path: str, algorithm: str = "sha512", glob: str = "*.zip") -> DataFrame:
    """Digest of every member, streamed so that member size does not matter."""

    def hash_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row, stream in _each_member(batch):
                h = hashlib.new(algorithm)
                while block := stream.read(STREAM_BYTES):
                    h.update(block)
                out.append((row.archive, row.member_path, row.size_bytes, h.hexdigest()))
            yield pd.DataFrame(out, columns=["archive", "path", "size_bytes", "actual"])

    return _spread(spark, path, glob).mapInPandas(
        hash_members, "archive string, path string, size_bytes long, actual string"
    )


def inside_manifests(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """(archive, manifest_path, line) of the manifests that archives carry themselves."""

    def read_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row, stream in _each_member(batch):
                lines = io.TextIOWrapper(stream, encoding="utf-8", errors="replace").read().splitlines()
                yield pd.DataFrame({"archive": row.archive, "manifest_path": row.member_path, "line": lines})

    named = _spread(spark, path, glob, paths.has_extension("member_path", ".hash"))
    return named.mapInPandas(read_lines, "archive string, manifest_path string, line string")


def safe_member(member: Column) -> Column:
    """The member's path with forward slashes; null if it could leave the target folder.

    Absolute paths, drive letters and ``..`` segments are refused.
    """
    clean = F.replace(member, F.lit("\\"), F.lit("/"))
    leaves = clean.startswith("/") | clean.rlike("^[A-Za-z]:") | clean.rlike(r"(^|/)\.\.(/|$)") | (clean == "")
    return F.when(~leaves, clean)


def place_members(spark: SparkSession, path: str, target: str, glob: str = "*.zip") -> DataFrame:
    """Unpack every member below ``target``/company/type, keeping folders.

    Returns (archive, member_path, target_path, size_bytes).  Members whose path could
    leave the target, and members of one archive that would be one file, are not written;
    their ``target_path`` is null.  Writing is idempotent, so a lost executor's members
    are simply written again.
    """
    safe = F.when(~F.col("meets"), safe_member(F.col("member_path")))
    name = F.element_at(F.split("archive", "/"), -1)
    routed = (
        _spread(spark, path, glob)
        .withColumn("company", F.coalesce(paths.routed_company(name), F.lit("unrouted")))
        .withColumn("kind", F.coalesce(F.lower(paths.routed_type(name)), F.lit("unknown")))
        .withColumn("target_path", F.when(safe.isNotNull(), F.concat_ws("/", F.lit(target), "company", "kind", "archive", safe)))
    )

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row, stream in _each_member(batch[batch["target_path"].notna()]):
                write_stream(row.target_path, stream)
            yield batch[["archive", "member_path", "target_path", "size_bytes"]]

    return routed.mapInPandas(copy, "archive string, member_path string, target_path string, size_bytes long")
