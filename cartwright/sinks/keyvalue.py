"""Key-value sink with a status per record."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..operators.keys import last_if_repeated
from ..schemas import WRITE_STATUS
from ..session import scratch_path
from ..sources.tables import load_write_status
from .tables import publish_table

BatchWriter = Callable[[pd.DataFrame], Iterable[str] | None]


@dataclass(frozen=True)
class Resend:
    """How refused items are sent again: so many attempts in all, at most ``pending``
    items waiting for the next, and a wait before it that doubles every time.

    A task waits once for up to ``pending`` items, so a store that refuses much slows a
    task down without holding its items in memory.
    """

    attempts: int = 5
    first_wait: float = 1.0
    pending: int = 10_000

    def wait(self, attempt: int) -> float:
        return self.first_wait * 2 ** (attempt - 1)


ONCE = Resend(attempts=1)


def _refused(writer: BatchWriter, batch: pd.DataFrame) -> pd.Series:
    """Which items of a batch the store did not take."""
    try:
        refused = writer(batch)
        return batch["record_id"].isin([] if refused is None else list(refused))
    except Exception:
        logging.getLogger(__name__).exception("a batch of %d items failed", len(batch))
        return pd.Series(True, index=batch.index)


def _put(
    batches: Iterator[pd.DataFrame], writer: BatchWriter, resend: Resend
) -> Iterator[pd.DataFrame]:
    """Send all batches; what was refused is queued and sent again in rounds."""

    def status(batch: pd.DataFrame, written: bool) -> pd.DataFrame:
        return pd.DataFrame({"record_id": batch["record_id"], "written": written})

    def sent_again(queue: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left = pd.concat(queue, ignore_index=True)
        for attempt in range(1, resend.attempts):
            time.sleep(resend.wait(attempt))
            refused = _refused(writer, left)
            yield status(left[~refused], True)
            left = left[refused].reset_index(drop=True)
            if left.empty:
                return
        yield status(left, False)

    queue: list[pd.DataFrame] = []
    waiting = 0
    for batch in batches:
        refused = _refused(writer, batch)
        if resend.attempts == 1:  # nothing is kept for a second attempt
            yield pd.DataFrame({"record_id": batch["record_id"], "written": ~refused})
            continue
        yield status(batch[~refused], True)
        if refused.any():
            queue.append(batch[refused])
            waiting += int(refused.sum())
        if waiting >= resend.pending:
            yield from sent_again(queue)
            queue, waiting = [], 0
    if queue:
        yield from sent_again(queue)


def write_kv(
    items: DataFrame,
    writer: BatchWriter,
    status_path: str,
    all_or_nothing: bool = False,
    resend: Resend = ONCE,
) -> DataFrame:
    """Put every item and return the stored status (record_id, written).

    ``writer`` runs on the executors and gets the items batch by batch, as a
    pandas frame (record_id, record_type, item). It returns the record ids that the
    store refused, if any, and raises when the whole batch failed; the reason is
    logged. Refused items are sent again as ``resend`` says, and the status is that of
    their last attempt. Lost tasks are run again, so it has to put by key. The last item
    of a repeated key wins. With ``all_or_nothing`` one failed record marks all as failed,
    though others may have been put. The status is stored once, as it is returned.
    """

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _put(batches, writer, resend)

    # Writing the attempts is what runs the puts, once per task.
    spark = items.sparkSession
    attempts = scratch_path(spark, "attempts")
    last_if_repeated(items, "record_id").mapInPandas(put, WRITE_STATUS).write.parquet(attempts)
    status = spark.read.schema(WRITE_STATUS).parquet(attempts)
    if all_or_nothing:
        whole = status.agg(F.coalesce(F.bool_and("written"), F.lit(True)).alias("w")).scalar()
        status = status.withColumn("written", whole)
    return _stored(status, status_path)


def store_items(items: DataFrame, name: str, root: str, status_path: str) -> DataFrame:
    """The same without a key-value store: keep the items as one table keyed by record_id."""
    stored = publish_table(last_if_repeated(items, "record_id"), name, root)
    return _stored(stored.select("record_id", F.lit(True).alias("written")), status_path)


def _stored(status: DataFrame, path: str) -> DataFrame:
    status.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return load_write_status(status.sparkSession, path)
