"""Layers that appear together.

A run writes its layers to a folder of its own.  When all writes have ended, a
pointer to the run is put beside the earlier ones; the one with the highest
number counts.  Readers resolve it once and then read one run's layers: a run
that failed half-way is never seen, and what a reader has resolved stays.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

from ledgerlake.functions.rules import Profile
from ledgerlake.plans import jobs
from ledgerlake.plans.jobs import LayerStore


@dataclass
class Published:
    """Runs under ``root``/runs, pointers under ``root``/published."""
    spark: SparkSession
    root: str
    layout: str | None = None

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _fs(self):
        return self._path("").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def begin(self) -> LayerStore:
        """A store for a new run; nothing of it is seen before :meth:`publish`."""
        return LayerStore(self.spark, root=f"{self.root}/runs/{uuid.uuid4().hex}", layout=self.layout)

    def _pointers(self) -> list[str]:
        """Names of the pointers, ``number-run``; a name is put as a whole, so there is no half one."""
        fs, folder = self._fs(), self._path("published")
        return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []

    def publish(self, run: LayerStore) -> int:
        """Let readers see ``run``.  Of two at the same time the later name wins; both stay whole."""
        had = self._pointers()
        number = int(had[-1].split("-")[0]) + 1 if had else 0
        name = run.root.rsplit("/", 1)[1]
        if not self._fs().mkdirs(self._path(f"published/{number:012d}-{name}")):
            raise OSError("the pointer could not be put")
        return number

    def current(self) -> LayerStore:
        """The store of the run that counts now; it goes on to be that run's."""
        had = self._pointers()
        if not had:
            raise FileNotFoundError(f"nothing is published under {self.root}")
        return LayerStore(self.spark, root=f"{self.root}/runs/{had[-1].split('-', 1)[1]}", layout=self.layout)


def quality(store: LayerStore, published: Published, profile: str | Profile = "local", **kw) -> dict:
    """The quality job over the bronze of ``store``; silver and quarantine appear together."""
    run = published.begin()
    counts = jobs.quality(store, profile, into=run, **kw)
    published.publish(run)
    return counts
