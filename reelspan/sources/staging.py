"""What the file sinks share: a job's files are written aside and moved into place once, when all tasks are done.

Paths are those that pyarrow's file systems open, so a cluster's shared store works as a local folder does.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from urllib.parse import quote

from pyarrow import fs
from pyspark.sql.datasource import WriterCommitMessage


def opened(path: str) -> tuple[fs.FileSystem, str]:
    store, top = fs.FileSystem.from_uri(path)
    return store, top.rstrip("/")


def file_name(text: str) -> str:
    """text as one part of a path, different texts under different names."""
    made = quote(text, safe=" ()+,;=@!$&'")
    return f"%{ord(made[0]):02X}{made[1:]}" if made[:1] in (".", "_") else made or "%"


@dataclass
class Staged(WriterCommitMessage):
    """Files of one attempt: (where it lies, relative to the job's folder; where it belongs, relative to the target)."""

    files: list[tuple[str, str]] = field(default_factory=list)
    rows: int = 0


class Job:
    """One write.  Only files that a commit message names are moved, so those of failed and repeated attempts never show.

    A repeated commit finds the files it has moved already in place and goes on with the rest.
    """

    def __init__(self, path: str):
        self.path, self.id = path, uuid.uuid4().hex

    def folder(self) -> str:
        return f"{opened(self.path)[1]}/_temporary/{self.id}"

    def begin(self) -> tuple[fs.FileSystem, str]:
        """A folder of this attempt."""
        store, _ = opened(self.path)
        attempt = uuid.uuid4().hex
        store.create_dir(f"{self.folder()}/{attempt}", recursive=True)
        return store, attempt

    def commit(self, messages: list[Staged | None]) -> None:
        store, top = opened(self.path)
        store.create_dir(top, recursive=True)
        made: set[str] = set()
        for m in messages:
            for at, to in m.files if m else ():
                parent = f"{top}/{to}".rpartition("/")[0]
                if parent not in made:
                    store.create_dir(parent, recursive=True)
                    made.add(parent)
                source = f"{self.folder()}/{at}"
                if store.get_file_info(source).type != fs.FileType.NotFound:
                    store.move(source, f"{top}/{to}")
                elif store.get_file_info(f"{top}/{to}").type == fs.FileType.NotFound:
                    raise FileNotFoundError(f"a committed file is gone: {source}")
        self.abort()

    def abort(self) -> None:
        store, top = opened(self.path)
        if store.get_file_info(self.folder()).type != fs.FileType.NotFound:
            store.delete_dir(self.folder())
        if store.get_file_info(f"{top}/_temporary").type != fs.FileType.NotFound and not store.get_file_info(fs.FileSelector(f"{top}/_temporary")):
            store.delete_dir(f"{top}/_temporary")
