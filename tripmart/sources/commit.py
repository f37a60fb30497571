"""Landing in two steps: a run writes aside, and its months are swapped in when all of it has been written.

    dest/_landing/<run>/try-<n>/vehicle_type=…   what the run has written, by year and month
    dest/_landing/<run>/commit.json              the list of its months; from here on the run counts as landed
    dest/_landing/<run>/cleared/…                months whose old files have been moved to …/old

Before the list is there, nothing below dest/raw has changed, and an interrupted run is rolled back by
deleting its folder. With the list, an interrupted run is finished by whoever lands next: months are moved
one after the other, each step of which can be repeated. Moving a month is a rename of its folder, one step on
file systems that have one; on plain object stores, where it isn't, readers may meet a month in between.
One run at a time may land to a destination.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession

from tripmart.sources.files import Store

ASIDE, LIST, LEDGER = "_landing", "commit.json", "ledger"
ABANDONED_HOURS = 24.0
MonthKey = tuple[str, int, int]  # vehicle type, year, month


def raw_path(dest: str, vehicle_type: str) -> str:
    return f"{dest.rstrip('/')}/raw/vehicle_type={vehicle_type}"


def _folder(key: MonthKey) -> str:
    return f"year={key[1]}/month={key[2]}"


class Run:
    def __init__(self, spark: SparkSession, dest: str, name: str | None = None):
        self.spark, self.dest, self.store = spark, dest.rstrip("/"), Store(spark)
        self.name = name or uuid.uuid4().hex
        self.root = f"{self.dest}/{ASIDE}/{self.name}"
        self.tries = 0

    def aside(self, vehicle_type: str) -> str:
        """A new empty place for a feed; what an earlier attempt left is not committed."""
        self.tries += 1
        return f"{self.root}/try-{self.tries}/vehicle_type={vehicle_type}"

    @property
    def ledger(self) -> str:
        """Where the run's own ledger rows are put before it is committed."""
        return f"{self.root}/{LEDGER}"

    def commit(self, months: Iterable[tuple[MonthKey, str]]) -> None:
        """From here on the months count as landed; each comes with the place that holds it."""
        self.store.write(f"{self.root}/{LIST}", json.dumps([[*key, place] for key, place in months]))

    def committed(self) -> bool:
        return self.store.exists(f"{self.root}/{LIST}")

    def finish(self) -> None:
        """Swap in the months of the list. May be repeated after an interruption."""
        for *key, place in json.loads(self.store.read(self.spark, f"{self.root}/{LIST}")):
            self._swap(tuple(key), f"{place}/{_folder(tuple(key))}")
        if self.store.exists(self.ledger):
            self.store.move(self.ledger, f"{self.dest}/{LEDGER}/run={self.name}")
        self.store.delete(self.root)

    def _swap(self, key: MonthKey, incoming: str) -> None:
        if not self.store.exists(incoming):
            return  # moved before an interruption
        target = f"{raw_path(self.dest, key[0])}/{_folder(key)}"
        mark = f"{self.root}/cleared/{key[0]}-{key[1]}-{key[2]}"
        if not self.store.exists(mark):
            if self.store.exists(target):
                self.store.move(target, f"{self.root}/old/vehicle_type={key[0]}/{_folder(key)}")
            self.store.write(mark, "")
        self.store.move(incoming, target)

    def roll_back(self) -> None:
        self.store.delete(self.root)


def recover(spark: SparkSession, dest: str, abandoned_hours: float = ABANDONED_HOURS) -> tuple[list[str], list[str]]:
    """Finish interrupted runs that were committed, roll back others that are older than `abandoned_hours`.

    Returns the names of the runs finished and rolled back.
    """
    store, finished, rolled_back = Store(spark), [], []
    for path, is_folder in store.children(f"{dest.rstrip('/')}/{ASIDE}"):
        run = Run(spark, dest, path.rsplit("/", 1)[-1])
        if is_folder and run.committed():
            run.finish()
            finished.append(run.name)
        elif is_folder and store.age_hours(path) >= abandoned_hours:
            run.roll_back()
            rolled_back.append(run.name)
    return finished, rolled_back
