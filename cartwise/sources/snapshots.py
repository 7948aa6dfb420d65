"""Versions of a collection or a model side by side, the newest whole one being current.

A folder holds numbered snapshots. A writer fills a new one and marks it as its
last act; readers take the newest that is marked. So a job that fails, or is
still at work, leaves the previous state readable, and the parts of a snapshot
are always of one piece. The marker is a file created in one step, which needs
no rename and so holds on object stores too. The last ``KEPT`` whole snapshots
stay, so that a reader that has just opened the previous one can finish.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

#: Whole snapshots that stay when a new one is finished.
KEPT = 2

_NAME = re.compile(r"snapshot-(\d{12})-[0-9a-f]{32}")
_MARKER = "_WHOLE"


class Snapshots:
    """The snapshots in the folder ``path`` of any Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._hadoop(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _hadoop(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return bool(self._fs.exists(self._hadoop(path)))

    def names(self) -> list[str]:
        """All snapshots, oldest first, whole or not."""
        if not self.exists(self.path):
            return []
        found = [s.getPath().getName() for s in self._fs.listStatus(self._hadoop(self.path)) if s.isDirectory()]
        return sorted(n for n in found if _NAME.fullmatch(n))

    def is_whole(self, name: str) -> bool:
        return self.exists(f"{self.path}/{name}/{_MARKER}")

    def current(self) -> str | None:
        """Folder of the newest whole snapshot, if there is one."""
        return next((f"{self.path}/{n}" for n in reversed(self.names()) if self.is_whole(n)), None)

    def begin(self) -> str:
        """Folder for a new snapshot, to be filled and then finished.

        Numbered after all there are; two writers that begin at once get folders
        of their own, and the names' order decides whose is current.
        """
        last = max((int(_NAME.fullmatch(n).group(1)) for n in self.names()), default=0)
        return f"{self.path}/snapshot-{last + 1:012d}-{uuid.uuid4().hex}"

    def finish(self, place: str, kept: int = KEPT) -> None:
        """Mark a filled snapshot as whole; then drop all that is older than the last ``kept`` whole ones.

        Unfinished snapshots go only when they are older than all that stay: a newer one may
        still be written.
        """
        self._fs.create(self._hadoop(f"{place}/{_MARKER}"), True).close()
        names = self.names()
        whole = [n for n in names if self.is_whole(n)][-kept:]
        for name in names:
            if whole and name < whole[0]:
                self._fs.delete(self._hadoop(f"{self.path}/{name}"), True)
