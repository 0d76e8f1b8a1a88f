"""Days of a table in whole versions, one of which is published for each day.

A load writes the days it touches to a folder of its own, ``_loads/load=<id>``. A day is
published by an empty file whose name holds the day, a number that grows with each
publication of the table, and the load: ``_days/2017-01-05.00000003.<load>``. A store
makes a file or it does not, so a day changes all at once; of several files of a day the
one with the highest number counts. What has no such file was never finished, or has
been replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import SparkSession

from paytally.session import drop_path, file_system

DAY_FOLDER = "transaction_date="


@dataclass(frozen=True)
class Version:
    day: str
    number: int
    load: str

    @property
    def name(self) -> str:
        return f"{self.day}.{self.number:08}.{self.load}"


class DayVersions:
    """The versions of the days of the table at ``root``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root

    @staticmethod
    def new_load() -> str:
        return f"x{uuid.uuid4().hex}"

    def folder(self, load: str) -> str:
        return f"{self.root}/_loads/load={load}"

    def day_folder(self, version: Version) -> str:
        return f"{self.folder(version.load)}/{DAY_FOLDER}{version.day}"

    def _names(self, path: str) -> list[str]:
        fs, folder = file_system(self.spark, path)
        if not fs.exists(folder):
            return []
        return [entry.getPath().getName() for entry in fs.listStatus(folder)]

    def _days_in(self, path: str) -> set[str]:
        names = self._names(path)
        return {n.removeprefix(DAY_FOLDER) for n in names if n.startswith(DAY_FOLDER)}

    def written(self, load: str) -> list[str]:
        """Days of which the load has rows."""
        return sorted(self._days_in(self.folder(load)))

    def loose(self) -> set[str]:
        """Days that lie below the table itself, put there by others."""
        return self._days_in(self.root)

    def _marks(self) -> list[Version]:
        parts = (name.split(".") for name in self._names(f"{self.root}/_days"))
        return [Version(p[0], int(p[1]), p[2]) for p in parts if len(p) == 3]

    def current(self) -> dict[str, Version]:
        """The published version of each day."""
        return {v.day: v for v in sorted(self._marks(), key=lambda v: v.number)}

    def publish(self, load: str, days: Iterable[str]) -> None:
        """Make the load's rows the rows of these days."""
        before = self._marks()
        number = max((v.number for v in before), default=0) + 1
        days = set(days)

        def mark(day: str) -> None:
            path = f"{self.root}/_days/{Version(day, number, load).name}"
            fs, target = file_system(self.spark, path)
            fs.create(target, True).close()

        def unmark(version: Version) -> None:
            drop_path(self.spark, f"{self.root}/_days/{version.name}")

        with ThreadPoolExecutor(max_workers=16) as pool:
            list(pool.map(mark, sorted(days)))
            list(pool.map(unmark, (v for v in before if v.day in days)))

    def discard(self, load: str) -> None:
        drop_path(self.spark, self.folder(load))

    def drop_unused(self) -> int:
        """Delete loads, and days in them, that are not published; return how many."""
        current = {(v.load, v.day) for v in self.current().values()}
        used = {load for load, _ in current}
        dropped = 0
        for name in self._names(f"{self.root}/_loads"):
            load = name.removeprefix("load=")
            if load not in used:
                self.discard(load)
                dropped += 1
                continue
            for day in self.written(load):
                if (load, day) not in current:
                    drop_path(self.spark, self.day_folder(Version(day, 0, load)))
                    dropped += 1
        return dropped
