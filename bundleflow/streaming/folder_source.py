"""A streaming source over watched folders (SR-1, SR-2).

Built with Spark's Python data source API. Each time Spark asks for the latest
offset the watched folders are listed; what has come or gone since the last
listing is written as a snapshot file, and an offset is a snapshot's number.
So a micro-batch is a range of snapshots: read again after a failure or a
restart it gives the same rows, and every arrival is in one batch. A name that
went and came back arrives again.
"""

from __future__ import annotations

import datetime as dt
import json
import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from bundleflow.schemas import ARRIVAL

FORMAT = "folder_arrivals"
#: Names of a partition.
NAMES = 10_000


class Snapshots(InputPartition):
    def __init__(self, file: str, first: int, last: int):
        self.file, self.first, self.last = file, first, last


class FolderReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.below = [x for x in options.get("subfolders", "").split(",") if x]
        self.state = options["state"].rstrip("/")
        os.makedirs(self.state, exist_ok=True)
        self.known: set[str] | None = None
        self.last = 0

    def _file(self, no: int) -> str:
        return f"{self.state}/{no:012d}.json"

    def _load(self) -> None:
        """What the snapshots so far add up to."""
        self.known, self.last = set(), 0
        for name in sorted(n for n in os.listdir(self.state) if n.endswith(".json")):
            with open(f"{self.state}/{name}", encoding="utf-8") as f:
                snapshot = json.load(f)
            self.known.difference_update(snapshot["gone"])
            self.known.update(p for p, _ in snapshot["new"])
            self.last = int(name.split(".")[0])

    def _list(self) -> dict[str, bool]:
        there = {}
        for folder in [f"{self.path}/{x}" for x in self.below] or [self.path]:
            try:
                with os.scandir(folder) as entries:
                    there.update((e.path, e.is_dir(follow_symlinks=False)) for e in entries)
            except FileNotFoundError:
                continue  # not made yet
        return there

    def initialOffset(self) -> dict:
        return {"snapshot": 0}

    def latestOffset(self) -> dict:
        if self.known is None:
            self._load()
        there = self._list()
        new, gone = sorted(there.keys() - self.known), sorted(self.known - there.keys())
        if new or gone:
            now = dt.datetime.now(dt.timezone.utc).isoformat()
            part = f"{self._file(self.last + 1)}.part"
            with open(part, "w", encoding="utf-8") as f:
                json.dump({"ts": now, "new": [[p, there[p]] for p in new], "gone": gone}, f)
            os.rename(part, self._file(self.last + 1))
            self.last += 1
            self.known = set(there)
        return {"snapshot": self.last}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        out: list[InputPartition] = []
        for no in range(start["snapshot"] + 1, end["snapshot"] + 1):
            with open(self._file(no), encoding="utf-8") as f:
                n = len(json.load(f)["new"])
            out += [Snapshots(self._file(no), i, min(i + NAMES, n)) for i in range(0, n, NAMES)]
        return out or [Snapshots("", 0, 0)]

    def read(self, partition: Snapshots) -> Iterator[tuple]:
        if not partition.file:
            return
        with open(partition.file, encoding="utf-8") as f:
            snapshot = json.load(f)
        ts = dt.datetime.fromisoformat(snapshot["ts"])
        for path, is_dir in snapshot["new"][partition.first:partition.last]:
            yield path, is_dir, "moved_to" if is_dir else "close_write", ts

    def commit(self, end: dict) -> None:
        """Snapshots are kept: together they say what has been seen."""

    def stop(self) -> None:
        pass


class FolderArrivals(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return ARRIVAL

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return FolderReader(self.options)


def folder_arrivals(spark: SparkSession, path: str, state: str, subfolders: tuple[str, ...] = ()) -> DataFrame:
    """A stream of arrivals (schema ``ARRIVAL``): every entry of the folder, or
    of the named ``subfolders`` of it, once when it is first seen. ``state`` is
    a folder for the snapshots, one per query. The folder's names pass through
    the driver, as they would through a watching process; what is below an
    entry is not looked at."""
    spark.dataSource.register(FolderArrivals)
    return (spark.readStream.format(FORMAT).option("path", path).option("state", state)
            .option("subfolders", ",".join(subfolders)).load())
