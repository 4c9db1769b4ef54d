"""Opening and writing files by path or URI inside tasks."""

from __future__ import annotations

import re
import shutil
import uuid
from typing import BinaryIO

from pyarrow import fs

COPY_BYTES = 1 << 20
URI = re.compile(r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/]*)(/.*)?$", re.S)


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of ``/x``, ``file:/x``, ``hdfs://host/x`` or ``s3a://bucket/x``.

    Paths are taken as they are: spaces, ``#``, ``%`` and ``?`` are ordinary characters.
    """
    local = re.match(r"^file:/+", uri)
    if local:
        return fs.LocalFileSystem(), "/" + uri[local.end() :]
    parts = URI.match(uri)
    if not parts:
        return fs.LocalFileSystem(), uri
    scheme, host, path = parts.groups()
    filesystem, root = fs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}://{host}")
    return filesystem, root.rstrip("/") + (path or "/")


def open_read(uri: str):
    filesystem, path = locate(uri)
    return filesystem.open_input_file(path)


def write_stream(uri: str, source: BinaryIO) -> None:
    """Copy ``source`` to ``uri`` in blocks and publish it with a rename.

    The hidden temporary name is unique per attempt, so a repeated or
    speculative task cannot leave a half-written file under the final name.
    """
    filesystem, path = locate(uri)
    folder, name = path.rsplit("/", 1)
    filesystem.create_dir(folder, recursive=True)
    temporary = f"{folder}/_{name}.{uuid.uuid4().hex}"
    with filesystem.open_output_stream(temporary) as out:
        shutil.copyfileobj(source, out, COPY_BYTES)
    filesystem.move(temporary, path)
