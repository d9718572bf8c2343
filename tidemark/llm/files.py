"""Whole files written and read by tasks, in any store that pyarrow reaches. A file gets its name once
it is complete, so a task that is lost or run twice leaves either nothing or the same file."""

from __future__ import annotations

import uuid

from pyarrow import fs


def store(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def write_whole(path: str, parts: list[bytes]) -> None:
    where, name = store(path)
    where.create_dir(name.rpartition("/")[0], recursive=True)
    under_way = f"{name}.{uuid.uuid4().hex}.part"
    with where.open_output_stream(under_way) as f:
        for part in parts:
            f.write(part)
    where.move(under_way, name)


def read_part(path: str, start: int, length: int) -> bytes:
    where, name = store(path)
    with where.open_input_file(name) as f:
        return f.read_at(length, start)


def size_of(path: str) -> int:
    where, name = store(path)
    return where.get_file_info(name).size
