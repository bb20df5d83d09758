"""Byte streams in the shared folder, opened from inside tasks."""

from __future__ import annotations

from uuid import uuid4

from pyarrow import fs


def _located(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def make_folder(path: str) -> None:
    system, place = _located(path)
    system.create_dir(place, recursive=True)


def unique_name(suffix: str) -> str:
    """A name no other attempt of a task has.

    Only names that a finished task returns count, so what a lost attempt has
    written is never read.
    """
    return f"{uuid4().hex}{suffix}"


def open_write(path: str):
    system, place = _located(path)
    return system.open_output_stream(place, compression=None)


def open_read(path: str):
    """A file to read from any position."""
    system, place = _located(path)
    return system.open_input_file(place)


def open_stream(path: str):
    """A file to read from its start, uncompressed by nobody."""
    system, place = _located(path)
    return system.open_input_stream(place, compression=None)
