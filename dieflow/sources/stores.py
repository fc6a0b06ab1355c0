"""Files that tasks open themselves, by URI."""
from __future__ import annotations

from pyarrow import fs

# Scheme of a path -> scheme pyarrow knows. Add a store's scheme here; others raise.
SCHEMES = {
    "file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "gcs": "gs",
    "abfs": "abfs", "abfss": "abfss",
}


def scheme_of(path: str) -> str:
    head, found, _ = path.partition(":")
    return head if found and "/" not in head else "file"


class NoOpener(Exception):
    """A path of a store no opener is known for; fails the job, whatever the file's size."""


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """Filesystem and path on it."""
    scheme = scheme_of(path)
    if scheme not in SCHEMES:
        raise NoOpener(f"no opener for {scheme}: add the scheme to dieflow.sources.stores.SCHEMES")
    rest = path.partition(":")[2] if path.startswith(f"{scheme}:") else path
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/") if path.startswith("file:") else rest
    return fs.FileSystem.from_uri(f"{SCHEMES[scheme]}:{rest}")


class ReadFault(Exception):
    """A store could not be read; unlike a fault in a file's format this fails the task, so that it runs again."""


class StoreFile:
    """A file of a store whose own faults are told apart from those of the format on top."""

    def __init__(self, path: str):
        self.path = path
        self._file = self._run(lambda: _open_input(path))

    def _run(self, step):
        try:
            return step()
        except OSError as problem:
            raise ReadFault(f"{self.path}: {problem}") from problem

    def read(self, size: int = -1) -> bytes:
        return self._run(lambda: self._file.read() if size is None or size < 0 else self._file.read(size))

    def seek(self, offset: int, whence: int = 0) -> int:
        return self._run(lambda: self._file.seek(offset, whence))

    def size(self) -> int:
        return self._run(lambda: self._file.size())

    def tell(self) -> int:
        return self._file.tell()

    def seekable(self) -> bool:
        return True

    readable = seekable

    def close(self) -> None:
        self._file.close()

    @property
    def closed(self) -> bool:
        return self._file.closed

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.close()


def _open_input(path: str):
    filesystem, name = opened(path)
    return filesystem.open_input_file(name)
