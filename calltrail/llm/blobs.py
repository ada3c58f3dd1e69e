"""Binary files of executor tasks in the shared folder, through pyarrow's file systems.

A task writes its file under a name of its own attempt and returns the name as a row; Spark commits that row once. So a
lost or repeated task leaves an unnamed file behind and never a half-written one in the result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyarrow import fs


#: Hadoop's names of stores that pyarrow knows by another.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss", "wasb": "abfs"}


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def uri_of(folder: str) -> str:
    """Hadoop's URI as pyarrow has it: file:/x is file:///x, s3a://x is s3://x."""
    if folder.startswith("file:/") and not folder.startswith("file://"):
        return "file://" + folder[5:]
    scheme, mark, rest = folder.partition("://")
    return f"{_SCHEMES.get(scheme, scheme)}://{rest}" if mark else folder


class BlobWriter:
    """Appends parts to one new file; tell() is where the next part starts."""

    def __init__(self, folder: str, suffix: str):
        self.name = f"part-{uuid.uuid4().hex}{suffix}"
        self.system, path = _open(uri_of(folder))
        self.system.create_dir(path, recursive=True)
        self.out = self.system.open_output_stream(f"{path}/{self.name}", compression=None)
        self.at = 0

    def tell(self) -> int:
        return self.at

    def write(self, parts: Iterable[bytes]) -> None:
        for p in parts:
            self.out.write(p)
            self.at += len(p)

    def close(self) -> None:
        self.out.close()


class BlobReader:
    """Reads ranges of files in a folder, one file open at a time."""

    def __init__(self, folder: str):
        self.system, self.path = _open(uri_of(folder))
        self.name, self.file = None, None

    def read(self, name: str, at: int, size: int) -> bytes:
        """size below 0: to the file's end."""
        if name != self.name:
            if self.file is not None:
                self.file.close()
            self.name, self.file = name, self.system.open_input_file(f"{self.path}/{name}")
        self.file.seek(at)
        return self.file.read(size if size >= 0 else None)
