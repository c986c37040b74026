"""Writing to a search store in bulk requests, through a client that the caller brings.

A client is a function ``(index, actions) -> positions that the store refused``; it raises where the request as a
whole failed. Each task cuts its rows into requests by number and by bytes, sends what was refused
again after a wait, and fails the task when the retries are used up. An action names its document, so a task
that is run again writes the same state again.
"""

from __future__ import annotations

import re
import sys
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from webloom.sinks.documents import ANCHOR_FIELD, KEY, as_json, no_speculation, store_options, stored_form

FORMAT = "webloom_bulk"
Client = Callable[[str, list[dict]], Iterable[int]]
# A document is written whole; an addition puts texts into fields of one that is there.
INDEX, ADD = "index", "add"
_UNITS = {"": 1, "b": 1, "kb": 1 << 10, "mb": 1 << 20, "gb": 1 << 30, "ms": 0.001, "s": 1, "m": 60}


def amount(text: str) -> float:
    """Bytes or seconds of a size such as ``2mb`` or a time such as ``30s``."""
    found = re.fullmatch(r"\s*(\d+)\s*([a-z]*)\s*", text.lower())
    if not found or found[2] not in _UNITS:
        raise ValueError(f"unknown amount {text!r}")
    return int(found[1]) * _UNITS[found[2]]


@dataclass
class Sent(WriterCommitMessage):
    """What one task has written."""

    actions: int
    requests: int
    repeated: int


def requests(rows: Iterator[Row], entries: int, size: float) -> Iterator[list[dict]]:
    """Actions in requests of at most so many entries and bytes; an action beyond that size goes alone."""
    held, weight = [], 0
    for r in rows:
        own = len(r["document"].encode()) + len(r[KEY].encode())
        if held and (len(held) == entries or weight + own > size):
            yield held
            held, weight = [], 0
        held.append({"op": r["op"], "id": r[KEY], "document": r["document"]})
        weight += own
    if held:
        yield held


class BulkWriter(DataSourceWriter):
    def __init__(self, client: Client, options: dict[str, str]):
        given = {k.lower(): v for k, v in options.items()}
        self.client, self.index = client, given["es.resource"]
        self.entries = int(given["es.batch.size.entries"])
        self.size = amount(given["es.batch.size.bytes"])
        self.retries = int(given["es.batch.write.retry.count"])
        self.wait = amount(given["es.batch.write.retry.wait"])

    def _send(self, actions: list[dict]) -> int:
        """Number of times that something had to be sent again."""
        for tried in range(self.retries + 1):
            if tried:
                time.sleep(self.wait)
            try:
                actions = [actions[i] for i in sorted(self.client(self.index, actions))]
                failed = None
            except (OSError, RuntimeError) as error:  # the request as a whole
                failed = error
            if not actions and failed is None:
                return tried
        raise RuntimeError(f"{len(actions)} actions refused after {self.retries} retries") from failed

    def write(self, iterator: Iterator[Row]) -> Sent:
        sent = Sent(0, 0, 0)
        for actions in requests(iterator, self.entries, self.size):
            sent.repeated += self._send(actions)
            sent.actions += len(actions)
            sent.requests += 1
        return sent

    def commit(self, messages: list[Sent | None]) -> None:
        """Nothing is left to do: every task has its answers."""

    def abort(self, messages: list[Sent | None]) -> None:
        """What was written stays; the same write, run again, replaces it."""


def source(client: Client) -> type[DataSource]:
    class Bulk(DataSource):
        @classmethod
        def name(cls) -> str:
            return FORMAT

        def writer(self, schema, overwrite: bool) -> BulkWriter:
            return BulkWriter(client, self.options)

    return Bulk


def document_actions(documents: DataFrame) -> DataFrame:
    """``uuid, op, document``: every document whole."""
    return as_json(stored_form(documents)).select(KEY, F.lit(INDEX).alias("op"), "document")


def anchor_actions(anchors: DataFrame) -> DataFrame:
    """``uuid, op, document`` of flat anchors: one text, with its number of lines, added to the field of its language."""
    field = F.concat(F.lit(f"{ANCHOR_FIELD}."), F.col("lang"))
    added = F.to_json(F.struct(field.alias("field"), F.col("anchor").alias("text"), "n"))
    return anchors.select(KEY, F.lit(ADD).alias("op"), added.alias("document"))


def write_bulk(
    documents: DataFrame,
    index: str,
    client: Client,
    overrides: dict[str, str] | None = None,
    anchors: DataFrame | None = None,
) -> None:
    """Documents, then their flat anchors as additions, so that no document has to hold all of its anchors."""
    spark = documents.sparkSession
    no_speculation(spark)
    spark.dataSource.register(source(client))
    frames = [document_actions(documents)] + ([] if anchors is None else [anchor_actions(anchors)])
    for frame in frames:
        frame.write.format(FORMAT).mode("append").options(**store_options(index, overrides)).save()


# Ship this module with its writer, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
