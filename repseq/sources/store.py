"""Files of any store that Arrow reaches, by path or URI."""

from __future__ import annotations

import pyarrow.fs as fs


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def data_files(path: str) -> list[tuple[str, int]]:
    """Path and size of a file, or of the files of a folder in order of name; those that begin with ``_`` or ``.`` are not data."""
    system, inside = store(path)
    info = system.get_file_info(inside)
    if info.type == fs.FileType.File:
        return [(path, info.size)]
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    head = path.removesuffix(inside) if path.endswith(inside) else ""
    found = system.get_file_info(fs.FileSelector(inside, recursive=True))
    kept = [f for f in found if f.is_file and not any(p.startswith(("_", ".")) for p in f.path[len(inside) :].split("/") if p)]
    return sorted((head + f.path, f.size) for f in kept)
