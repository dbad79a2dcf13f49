"""A data source that writes objects as files, one per row.

A task writes its files under names of its attempt and puts them in place when all are complete, so a task that
is tried again leaves no second file and no half one. What an attempt puts in place is listed in a file of its own, and
what stood there is kept until the job ends: if the job fails, everything is put back.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

#: Folder of attempts and lists, below the target folder.
STAGING = "_staging"


def _located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return fs.LocalFileSystem(), path


def _there(system: fs.FileSystem, path: str) -> bool:
    return system.get_file_info(path).type != fs.FileType.NotFound


def checked_name(name: str | None) -> str:
    """A name that stays below its folder."""
    if not name or posixpath.isabs(name) or ".." in name.split("/") or name.split("/")[0] == STAGING:
        raise ValueError(f"not a name of an object file: {name!r}")
    return posixpath.normpath(name)


@dataclass
class Written(WriterCommitMessage):
    """Where a task lists the files it put in place, and how many they are."""

    listed: str
    files: int
    size: int


class ObjectFiles(DataSource):
    """Format ``object_files``: rows (object_name, content) become files below ``path``."""

    @classmethod
    def name(cls) -> str:
        return "object_files"

    def schema(self) -> str:
        return "object_name string, content binary"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("object files are replaced one by one: use mode append")
        return _Writer(self.options["path"].rstrip("/"), uuid.uuid4().hex)


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, job: str):
        self.path, self.job = path, job

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        system, root = _located(self.path)
        staging = f"{root}/{STAGING}/{self.job}/{uuid.uuid4().hex}"
        names: list[str] = []
        size = 0
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("object_name", "content")]
            for name, content in zip(*columns, strict=True):
                names.append(checked_name(name.as_py()))
                system.create_dir(staging, recursive=True)
                with system.open_output_stream(f"{staging}/{len(names)}") as file:
                    data = content.as_buffer() if content.is_valid else b""
                    file.write(data)
                    size += len(data)
        listed = f"{staging}.json"
        if names:
            # The list comes first: what is put in place is always listed.
            with system.open_output_stream(listed) as file:
                file.write(json.dumps(names).encode())
            for folder in {posixpath.dirname(n) for n in names}:
                system.create_dir(posixpath.join(root, folder), recursive=True)
            for k, name in enumerate(names):
                if _there(system, f"{root}/{name}"):
                    system.move(f"{root}/{name}", f"{staging}/old-{k}")
                system.move(f"{staging}/{k + 1}", f"{root}/{name}")
        return Written(listed, len(names), size)

    def commit(self, messages: list[Written | None]) -> None:
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        """Undo what attempts put in place, the last one first: the files that were there before come back."""
        system, root = _located(self.path)
        found = system.get_file_info(fs.FileSelector(f"{root}/{STAGING}/{self.job}", allow_not_found=True))
        for info in sorted((f for f in found if f.path.endswith(".json")), key=lambda f: f.mtime_ns, reverse=True):
            staging = info.path.removesuffix(".json")
            with system.open_input_stream(info.path) as file:
                names = json.loads(file.read())
            for k, name in enumerate(names):
                if not _there(system, f"{staging}/{k + 1}") and _there(system, f"{root}/{name}"):
                    system.delete_file(f"{root}/{name}")
                if _there(system, f"{staging}/old-{k}"):
                    system.move(f"{staging}/old-{k}", f"{root}/{name}")
        self._clear()

    def _clear(self) -> None:
        system, root = _located(self.path)
        if _there(system, f"{root}/{STAGING}/{self.job}"):
            system.delete_dir(f"{root}/{STAGING}/{self.job}")
