"""A log of numbered entries in a shared folder, by which writers agree on what is current.

An entry is a small JSON file. It is written under another name and then renamed
to its number, so it is whole as soon as it exists, it is never changed, and of
two writers that want the same number one gets :class:`CommitConflict`. Names
(such as that of a load) can point to entries; a pointer counts only if the entry
that it names agrees, so a writer that dies between the two leaves nothing behind
that could mislead.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import SparkSession


class CommitConflict(RuntimeError):
    """Another writer committed this number first."""


class CommitLog:
    """Entries ``commits/<number>`` and pointers ``names/<digest of a name>`` below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, name: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _put(self, name: str, content: str) -> None:
        fs, p = self._fs(name)
        out = fs.create(p, True)
        out.write(bytearray(content.encode()))
        out.close()

    def _get(self, name: str) -> str | None:
        fs, p = self._fs(name)
        if not fs.exists(p):
            return None
        return self.spark.read.text(f"{self.path}/{name}", wholetext=True).first()["value"]

    def numbers(self) -> list[int]:
        fs, p = self._fs("commits")
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(p)) if fs.exists(p) else []

    def entry(self, number: int) -> dict | None:
        text = self._get(f"commits/{number:012d}")
        return json.loads(text) if text is not None else None

    def last(self) -> tuple[int, dict] | None:
        known = self.numbers()
        return (known[-1], self.entry(known[-1])) if known else None

    def named(self, name: str) -> dict | None:
        """The entry that was added under this name."""
        number = self._get(_pointer(name))
        entry = self.entry(int(number)) if number is not None else None
        return entry if entry and entry.get("name") == name else None

    def add(self, number: int, entry: dict, name: str | None = None) -> None:
        """Make ``entry`` the one with this number, which must be free."""
        if name is not None:
            entry = {**entry, "name": name}
            self._put(_pointer(name), str(number))
        fs, p = self._fs(f"commits/{number:012d}")
        draft = f"drafts/{uuid.uuid4().hex}"
        self._put(draft, json.dumps(entry))
        fs.mkdirs(p.getParent())
        if fs.exists(p) or not fs.rename(self._fs(draft)[1], p):
            raise CommitConflict(f"{self.path}: number {number} is taken")


def _pointer(name: str) -> str:
    return f"names/{hashlib.sha256(name.encode()).hexdigest()}"
