"""Queues worked off in lots, as arbitrary state of a stream: what waits outlives batches and restarts."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Items that one entry of the state holds: few enough to be read for a lot, enough to make calls to the state rare.
BLOCK = 64
Decided = Row("queue", "lot", "item", "state")


class Lots(StatefulProcessor):
    """A queue is its front, and blocks from ``head`` to before ``tail`` behind it; a short one is its front alone.

    Each call to the state is a trip to the JVM and back, and costs more than the rest of
    a row's work: a queue's front is read and written once a batch, a block when the lots
    come to it or items are put into it.
    """

    def __init__(self, size: int) -> None:
        self.size = size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ends = handle.getValueState("ends", "head long, tail long, front array<long>")
        self.blocks = handle.getMapState("blocks", "block long", "items array<long>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        added, outcomes = [], {}
        for _, lot, item, position, result in rows:
            if lot is None:
                added.append((position, item))
            else:
                outcomes.setdefault(lot, {})[item] = result
        before = self.ends.get()
        head, tail, front = (before[0], before[1], list(before[2])) if before is not None else (0, 0, [])
        added.sort()
        tail = self._put([item for _, item in added], head, tail, front)
        for lot in sorted(outcomes):
            while len(front) < self.size and head < tail:
                front += self.blocks.getValue((head,))[0]
                self.blocks.removeKey((head,))
                head += 1
            kept, back, at = [], None, 0
            while at < min(self.size, len(front)) and back is None:
                item = front[at]
                result = outcomes[lot].get(item)
                at += 1
                if result is None:
                    kept.append(item)
                    continue
                if result == "limit":
                    back = item
                yield Decided(key[0], lot, item, "queued" if result == "limit" else result)
            front[:at] = kept
            if back is not None:
                tail = self._put([back], head, tail, front)
        if front or head < tail:
            self.ends.update((head, tail, front))
        elif before is not None:
            self.ends.clear()

    def _put(self, items: list[int], head: int, tail: int, front: list[int]) -> int:
        """Puts items behind all that waits and returns the new ``tail``; while there is no block, the front takes them up to a block's size."""
        taken = max(0, BLOCK - len(front)) if head == tail else 0
        front += items[:taken]
        items = items[taken:]
        if items and head < tail:
            last = list(self.blocks.getValue((tail - 1,))[0])
            if len(last) < BLOCK:
                tail, items = tail - 1, last + items
        for at in range(0, len(items), BLOCK):
            self.blocks.updateValue((tail,), (items[at : at + BLOCK],))
            tail += 1
        return tail

    def close(self) -> None:
        pass


def lots(stream: DataFrame, size: int) -> DataFrame:
    """(queue, lot, item, state) of every item that a lot decided: done, outside, or queued again at the end.

    The stream has ``queue``, ``lot``, ``item``, ``position`` and ``result``, keys and items
    being integers. Rows without a lot put items in, by position within a batch and behind
    those that wait. The others say what came of an item in a lot (done, outside, limit); a
    lot takes the first ``size`` items, an item without a result stays where it was, and the
    first limit puts its item at the end and ends the lot. Results of items that aren't in
    the lot say nothing. Lots of one batch run in order, behind what the batch put in; a lot
    comes in one batch. A task holds one queue's rows of one batch, and of what waits the
    lot and a block or two. Repeated items wait twice; rows without a queue form a queue of their own.
    """
    rows = stream.select(F.col("queue").cast("long"), F.col("lot").cast("long"), F.col("item").cast("long"), F.col("position").cast("long"), "result")
    return rows.groupBy("queue").transformWithState(Lots(size), "queue long, lot long, item long, state string", "append", "none")


def run_lots(stream: DataFrame, size: int, folder: str) -> DataFrame:
    """Runs :func:`lots` to the end of what has landed; with the same folder a later call goes on from the state of this one."""
    from millrace.streaming.files import run_to_end

    conf = stream.sparkSession.conf
    before = conf.get(PROVIDER, None)
    conf.set(PROVIDER, ROCKSDB)  # arbitrary state of this kind needs it
    try:
        return run_to_end(lots(stream, size), folder)
    finally:
        conf.unset(PROVIDER) if before is None else conf.set(PROVIDER, before)
