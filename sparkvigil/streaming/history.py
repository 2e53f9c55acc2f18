"""Customer history as keyed state of a stream.

Each customer's state is its number of rows, its fraud count and a ring of its newest rows, the ring
as one binary value: a nested array costs a pass of Python objects for every read and write. A
transaction gets its history when it arrives: from what its customer had until its own time. A label
may come with its transaction or later, as a row of its own; from then on it counts for every
transaction of the customer that arrives after it.
"""

from __future__ import annotations

import bisect
import datetime as dt
import operator
import struct
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sparkvigil.operators.features import HISTORY_ROWS

# Rows that the ring keeps beyond the frame, for transactions that come later than newer ones.
SLACK = 28
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# As objects: workers cannot parse type strings.
STATE = T.StructType().add("rows", T.LongType()).add("frauds", T.LongType()).add("newest", T.BinaryType())
# An entry of the ring: time in microseconds, id, label, and a bit for each of them that is not null.
ENTRY = struct.Struct("<qqqB")
EPOCH, MICRO = dt.datetime(1970, 1, 1), dt.timedelta(microseconds=1)
HISTORY = (
    T.StructType()
    .add("customer_fraud_rate", T.DoubleType())
    .add("customer_transaction_count", T.LongType())
    .add("customer_fraud_count", T.LongType())
)
# Rows of labels that come after their transactions have this mark.
LATE_LABEL = "late_label"


class Ring:
    """A customer's totals and newest rows (at, id, label), oldest first."""

    def __init__(self, rows: int, frauds: int, newest: list[tuple], frame: int, slack: int) -> None:
        self.rows, self.frauds, self.frame, self.size = rows, frauds, frame, frame + slack
        self.newest = newest
        self.count_frame()

    def count_frame(self) -> None:
        """Labels and frauds among the newest ``frame`` rows, kept up as rows follow."""
        labels = [e[2] for e in self.newest[max(0, len(self.newest) - self.frame) :] if e[2] is not None]
        self.known, self.hits = len(labels), sum(labels)

    def add(self, at: dt.datetime | int | None, number: int, label: int | None) -> tuple[float, int, int]:
        """The history of a transaction (rate before it, counts up to it), which is then part of it."""
        if self.newest and order(at, number) < order(*self.newest[-1][:2]):
            return self.add_late(at, number, label)
        rate = self.hits / self.known if self.known else 0.0
        self.rows += 1
        self.frauds += label or 0
        self.newest.append((at, number, label))
        self.count(label, 1)
        if len(self.newest) > self.frame:
            self.count(self.newest[-1 - self.frame][2], -1)
        self.trim()
        return rate, self.rows, self.frauds

    def add_late(self, at: dt.datetime | int | None, number: int, label: int | None) -> tuple[float, int, int]:
        """The same for a transaction that comes after newer ones."""
        place = bisect.bisect_right(self.newest, order(at, number), key=lambda e: order(e[0], e[1]))
        later = self.newest[place:]
        before = [e[2] for e in self.newest[max(0, place - self.frame) : place] if e[2] is not None]
        rate = sum(before) / len(before) if before else 0.0
        self.rows += 1
        self.frauds += label or 0
        self.newest.insert(place, (at, number, label))
        self.trim()
        self.count_frame()
        return rate, self.rows - len(later), self.frauds - sum(e[2] or 0 for e in later)

    def count(self, label: int | None, by: int) -> None:
        if label is not None:
            self.known += by
            self.hits += by * label

    def trim(self) -> None:
        del self.newest[: max(0, len(self.newest) - self.size)]

    def correct(self, number: int, label: int | None) -> None:
        """A label that came later; one of a transaction that has left the ring still counts."""
        for i in range(len(self.newest) - 1, -1, -1):
            at, known, before = self.newest[i]
            if known == number:
                self.frauds += (label or 0) - (before or 0)
                self.newest[i] = (at, known, label)
                if i >= len(self.newest) - self.frame:
                    self.count(before, -1)
                    self.count(label, 1)
                return
        self.frauds += label or 0


def order(at: dt.datetime | int | None, number: int) -> tuple:
    """Rows without a time come first."""
    return (at is not None, 0 if at is None else at, number)


def micros(at: dt.datetime | None) -> int | None:
    return None if at is None else (at.replace(tzinfo=None) - EPOCH) // MICRO


def packed(newest: Iterable[tuple]) -> bytes:
    """The rows of a ring, their times as microseconds, as one value."""
    return b"".join(
        ENTRY.pack(at or 0, number or 0, label or 0, (at is not None) | (number is not None) << 1 | (label is not None) << 2)
        for at, number, label in newest
    )


def unpacked(value: bytes) -> list[tuple]:
    return [
        (at, number, label) if known == 7 else (at if known & 1 else None, number if known & 2 else None, label if known & 4 else None)
        for at, number, label, known in ENTRY.iter_unpack(value)
    ]


class History(StatefulProcessor):
    """History columns for the rows of each customer, in the order of time and id within a micro-batch."""

    def __init__(self, columns: list[str], frame: int, slack: int) -> None:
        self.columns, self.frame, self.slack = columns, frame, slack

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("history", STATE)

    def ring(self) -> Ring:
        # Every call of the state is a message to the JVM: none asks first whether there is a value.
        rows, frauds, newest = self.state.get() or (0, 0, b"")
        return Ring(rows, frauds, unpacked(newest), self.frame, self.slack)

    def keep(self, ring: Ring) -> None:
        self.state.update((ring.rows, ring.frauds, packed(ring.newest)))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        entries = ((micros(e["at"]), e["id"], e["label"]) for e in initialState["newest"])
        newest = sorted(entries, key=lambda e: order(e[0], e[1]))
        self.keep(Ring(initialState["rows"], initialState["frauds"], newest, self.frame, self.slack))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        ring = self.ring()
        result = Row(*self.columns, *HISTORY.names)
        arrived, names = [], None
        for row in rows:
            # Places instead of names: a row looks a name up among its fields every time.
            if names is None:
                names = row.__fields__
                kept = [names.index(c) for c in self.columns]
                when, which, what = (names.index(c) for c in ("transaction_datetime", "transaction_id", "is_fraud"))
                mark = names.index(LATE_LABEL) if LATE_LABEL in names else None
            row = tuple(row)
            at, number = micros(row[when]), row[which]
            # A label counts from its own time on: with equal times, after the transactions.
            late = mark is not None and bool(row[mark])
            arrived.append((*order(at, 0)[:2], late, number, at, row[what], row))
        arrived.sort(key=operator.itemgetter(0, 1, 2, 3))
        for _, _, late, number, at, label, row in arrived:
            if late:
                ring.correct(number, label)
            else:
                yield result(*[row[i] for i in kept], *ring.add(at, number, label))
        self.keep(ring)

    def close(self) -> None:
        pass


def history_stream(
    stream: DataFrame, initial: DataFrame | None = None, frame: int = HISTORY_ROWS, slack: int = SLACK
) -> DataFrame:
    """A stream of timed transactions with the three columns of customer history.

    Rows of a customer that arrive in the order of their times get what ``with_customer_history`` gives
    them in a table, however the stream is cut into micro-batches, also after a restart from its
    checkpoint. One that arrives after newer rows is put in its place: it sees the rows before its
    time (exactly if at most ``slack`` newer ones came first), and later arrivals see it. ``initial``
    is a customer state (``customer_state``) to start from. A boolean column ``late_label`` marks rows
    that bring only a label of an earlier transaction; they are not passed on.

    A customer's rows of one micro-batch are handled by one task: ``maxFilesPerTrigger`` bounds them.
    Every column goes through Python, value by value: pass only those that are used afterwards.
    The state of a customer is ``frame + slack`` entries.
    """
    spark = stream.sparkSession
    spark.conf.set(STATE_STORE, ROCKS)
    columns = [c for c in stream.columns if c != LATE_LABEL]
    rows = stream.withColumn("is_fraud", F.col("is_fraud").cast("bigint"))
    schema = rows.select(*columns).schema
    for f in HISTORY.fields:
        schema = schema.add(f)
    known = None if initial is None else initial.select("customer_id", "rows", "frauds", "newest").groupBy("customer_id")
    return rows.groupBy("customer_id").transformWithState(
        statefulProcessor=History(columns, frame, slack),
        outputStructType=schema,
        outputMode="Append",
        timeMode="None",
        initialState=known,
    )
