"""An index on files that grows run by run: immutable folders and a log of commits.

A run is a crawl written in batches; what one batch wrote is a generation, a folder of documents and one
of their anchors. A folder counts only once it stands in the log ``<path>/_commits``. Each commit is one
small file that names all live generations, numbered in sequence and created by one rename: it
appears as a whole or not at all, and of two writers with the same number one has to look again.
Folders are never changed, so a reader keeps the snapshot it began with, whatever is committed meanwhile.

For each key the newest run wins, within a run the last batch: a second run replaces what it brings
again and leaves the rest. Anchors follow their document: a document that came again without anchors has none.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from webloom.sinks import files
from webloom.sinks.documents import KEY, no_speculation

LOG = "_commits"
DOCUMENTS, ANCHORS = "documents", "anchors"
ORDER = ["run", "batch", "merged"]


@dataclass(frozen=True)
class Generation:
    """Folders written by one batch of one run; ``merged`` if older ones were compacted into them."""

    run: int
    batch: int
    attempt: str
    kinds: tuple[str, ...]
    merged: bool = False

    def folder(self, path: str, kind: str) -> str:
        # as partition values: readers get the order of generations with the rows
        return f"{path}/{kind}/run={self.run}/batch={self.batch}/merged={int(self.merged)}/attempt={self.attempt}"


@dataclass(frozen=True)
class Run:
    """``done``: the counters of each finished batch, by the fingerprint of what it was made from."""

    number: int
    name: str
    done: dict[str, dict[str, int]] = field(default_factory=dict)


@dataclass(frozen=True)
class Snapshot:
    """One state of the log."""

    version: int = 0
    runs: tuple[Run, ...] = ()
    generations: tuple[Generation, ...] = ()

    def run(self, number: int) -> Run:
        return next(r for r in self.runs if r.number == number)

    @classmethod
    def of(cls, text: str) -> Snapshot:
        given = json.loads(text)
        generations = (Generation(**{**g, "kinds": tuple(g["kinds"])}) for g in given["generations"])
        return cls(given["version"], tuple(Run(**r) for r in given["runs"]), tuple(generations))


def _place() -> Column:
    """Compares generations: the later the larger; at equal batches what was merged is older."""
    return F.struct("run", "batch", (-F.col("merged")).alias("own"))


class Index:
    """The index at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ---- the log -------------------------------------------------------------------------

    def versions(self) -> list[int]:
        return [int(n) for n in files.names(self.spark, f"{self.path}/{LOG}") if n.isdigit()]

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The newest state, or that of one version; an empty one before the first commit."""
        known = self.versions()
        if version is None:
            version = max(known, default=0)
        elif version not in known:
            raise ValueError(f"{self.path} has no version {version}")
        return Snapshot.of(files.read_text(self.spark, self._entry(version))) if version else Snapshot()

    def _entry(self, version: int) -> str:
        return f"{self.path}/{LOG}/{version:020d}"

    def commit(self, change: Callable[[Snapshot], Snapshot]) -> Snapshot:
        """Apply ``change`` to the newest state, again if another writer was faster."""
        while True:
            old = self.snapshot()
            new = replace(change(old), version=old.version + 1)
            if files.write_once(self.spark, self._entry(new.version), json.dumps(asdict(new))):
                return new

    # ---- writing -------------------------------------------------------------------------

    def start_run(self, name: str | None = None) -> Run:
        """The run of this name, to go on with it; without a name, or with a new one, a new run."""
        name = name or uuid.uuid4().hex

        def begin(old: Snapshot) -> Snapshot:
            if any(r.name == name for r in old.runs):
                return old
            number = max((r.number for r in old.runs), default=0) + 1
            return replace(old, runs=(*old.runs, Run(number, name)))

        found = [r for r in self.snapshot().runs if r.name == name]
        return found[0] if found else next(r for r in self.commit(begin).runs if r.name == name)

    def write(self, kind: str, rows: DataFrame, generation: Generation) -> DataFrame:
        """Write one kind of rows of a generation, and read them back; nobody else sees them yet."""
        no_speculation(self.spark)
        folder = generation.folder(self.path, kind)
        rows.write.parquet(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)

    def add(self, generation: Generation, fingerprint: str, counters: dict[str, int]) -> Snapshot:
        """Commit what was written as ``generation``; it replaces an earlier attempt at the same batch."""

        def added(old: Snapshot) -> Snapshot:
            same = lambda g: (g.run, g.batch, g.merged) == (generation.run, generation.batch, False)
            runs = tuple(
                replace(r, done={**r.done, fingerprint: counters}) if r.number == generation.run else r
                for r in old.runs
            )
            kept = tuple(g for g in old.generations if not same(g))
            return replace(old, runs=runs, generations=(*kept, generation))

        return self.commit(added)

    # ---- reading -------------------------------------------------------------------------

    def _rows(self, snapshot: Snapshot, kind: str) -> DataFrame | None:
        folders = [g.folder(self.path, kind) for g in snapshot.generations if kind in g.kinds]
        return self.spark.read.option("basePath", f"{self.path}/{kind}").parquet(*folders) if folders else None

    def _replaced(self, snapshot: Snapshot) -> DataFrame:
        """Keys that stand in several generations, with the newest: short unless crawls overlap."""
        place = _place()
        found = self._rows(snapshot, DOCUMENTS).groupBy(KEY).agg(F.max(place).alias("newest"), F.min(place).alias("oldest"))
        return found.where(F.col("newest") > F.col("oldest")).select(KEY, "newest")

    def _current(self, snapshot: Snapshot, kind: str) -> DataFrame | None:
        """Only keys are shuffled to find what was replaced; the rows are filtered where they lie
        as long as the list of replaced keys is small enough for Spark to send it to them."""
        rows = self._rows(snapshot, kind)
        if rows is None:
            return None
        kept = [c for c in rows.columns if c not in (*ORDER, "attempt")]
        if len(snapshot.generations) == 1:
            return rows.select(kept)
        newest = rows.join(self._replaced(snapshot), KEY, "left")
        return newest.where(_place() == F.coalesce("newest", _place())).select(kept)

    def documents(self, snapshot: Snapshot | None = None) -> DataFrame | None:
        """The newest of each document in a snapshot; None if it holds none."""
        return self._current(snapshot or self.snapshot(), DOCUMENTS)

    def anchors(self, snapshot: Snapshot | None = None) -> DataFrame | None:
        """The flat anchors of these documents."""
        return self._current(snapshot or self.snapshot(), ANCHORS)

    # ---- upkeep --------------------------------------------------------------------------

    def compact(self) -> Snapshot:
        """Write the current rows once, in place of all generations of the snapshot they come from.

        Generations committed meanwhile stay as they are, and are newer.
        """
        old = self.snapshot()
        if not old.generations:
            return old
        last = max(old.generations, key=lambda g: (g.run, g.batch))
        frames = {k: f for k, f in ((DOCUMENTS, self.documents(old)), (ANCHORS, self.anchors(old))) if f is not None}
        merged = Generation(last.run, last.batch, attempt(), tuple(frames), merged=True)
        for kind, rows in frames.items():
            self.write(kind, rows, merged)
        return self.commit(
            lambda now: replace(now, generations=(merged, *(g for g in now.generations if g not in old.generations)))
        )

    def vacuum(self, keep_versions: int = 2, least_age: float = 24 * 3600) -> list[str]:
        """Delete folders that none of the newest versions names, unless they are younger than ``least_age`` seconds.

        Readers of older versions and writers that take longer than that would lose their folders.
        """
        named = {
            g.folder(self.path, k) for v in self.versions()[-keep_versions:] for g in self.snapshot(v).generations for k in g.kinds
        }
        found = files.matching(self.spark, f"{self.path}/*/run=*/batch=*/merged=*/attempt=*")
        gone = [p for p, age in found if age >= least_age and not any(p.endswith(n) for n in named)]
        for p in gone:
            files.delete(self.spark, p)
        return gone


def attempt() -> str:
    return f"a{uuid.uuid4().hex}"
