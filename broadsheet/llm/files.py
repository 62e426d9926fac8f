"""Files that tasks write to and read from the shared folder."""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder given as path or URI (file, hdfs, s3, gs ... as pyarrow knows them)."""
    fs, path = pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)
    return fs, path


def new_name(folder: str, suffix: str) -> str:
    """A name no other attempt of the task uses: an index lists only the files of the attempts that Spark committed."""
    return f"{folder.rstrip('/')}/part-{uuid.uuid4().hex}{suffix}"
