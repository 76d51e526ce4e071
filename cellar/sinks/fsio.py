"""File access inside tasks through pyarrow's file systems (local paths, file:, hdfs:, s3:, gs:)."""

from __future__ import annotations

import uuid


def resolve(uri: str):
    from pyarrow import fs

    if uri.startswith("file:"):
        p = uri[len("file:"):]
        while p.startswith("//"):
            p = p[1:]
        return fs.LocalFileSystem(), p
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def write_bytes(uri: str, data: bytes) -> None:
    fsys, p = resolve(uri)
    parent = p.rsplit("/", 1)[0]
    if parent:
        fsys.create_dir(parent, recursive=True)
    tmp = f"{p}.tmp"
    with fsys.open_output_stream(tmp) as fh:
        fh.write(data)
    fsys.move(tmp, p)


def read_bytes(uri: str) -> bytes:
    fsys, p = resolve(uri)
    with fsys.open_input_stream(p) as fh:
        return fh.read()


def exists(uri: str) -> bool:
    from pyarrow import fs

    fsys, p = resolve(uri)
    return fsys.get_file_info(p).type != fs.FileType.NotFound


def open_output(uri: str):
    fsys, p = resolve(uri)
    parent = p.rsplit("/", 1)[0]
    if parent:
        fsys.create_dir(parent, recursive=True)
    return fsys.open_output_stream(p)


def move(src: str, dst: str) -> None:
    """Rename, also onto an existing file. Where a file system refuses that, the old file is put
    aside, and back again if the new one can't take its place."""
    fsys, s = resolve(src)
    _, d = resolve(dst)
    try:
        fsys.move(s, d)
    except OSError:
        if not exists(dst) or not exists(src):
            raise
        aside = f"{d}.{uuid.uuid4().hex[:8]}.old"
        fsys.move(d, aside)
        try:
            fsys.move(s, d)
        except OSError:
            fsys.move(aside, d)
            raise
        fsys.delete_file(aside)


def delete_file(uri: str) -> None:
    fsys, p = resolve(uri)
    fsys.delete_file(p)


def open_input_file(uri: str):
    """Seekable input (for zip central directories)."""
    fsys, p = resolve(uri)
    return fsys.open_input_file(p)
