"""Score transactions as their files arrive."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sparkvigil.session import passing_scratch, stage
from sparkvigil.sources.tables import split_rejects
from sparkvigil.streaming.sink import FAN, StreamSink

SCORED, REJECTS = "scored", "rejects"


def score_stream(
    stream: DataFrame,
    score: Callable[[DataFrame], DataFrame | Mapping[str, DataFrame]],
    sink: str,
    checkpoint: str,
    available_now: bool = True,
    fan: int = FAN,
) -> StreamingQuery:
    """Start scoring a stream into the tables below ``sink``.

    ``score`` is the batch function: each micro-batch goes through the same plan as a stored table,
    hot-key checks included. It returns the scored rows, or several outputs by name (see
    ``with_rejects``). All outputs of a micro-batch count from one commit on, under the stream's id,
    which its checkpoint keeps, and the micro-batch's number: one that is run again after a failure
    adds nothing twice, and other streams may write to the same sink. After ``fan`` commits they are
    folded into larger files. Intermediate tables of a micro-batch go when it is written.
    ``maxFilesPerTrigger`` of the source bounds a micro-batch.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        query_id = spark.read.json(f"{checkpoint}/metadata").first()["id"]
        table = StreamSink(spark, sink, fan)
        if not table.committed(query_id, number):
            with passing_scratch(spark):
                found = score(batch)
                table.append(query_id, number, found if isinstance(found, Mapping) else {SCORED: found})
        table.fold_when_due()

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def with_rejects(
    parse: Callable[[DataFrame], DataFrame], score: Callable[[DataFrame], DataFrame]
) -> Callable[[DataFrame], dict[str, DataFrame]]:
    """A function for ``score_stream``: parsed rows are scored, the others kept with their reason.

    The parsed rows are written once, so both outputs see the same ones.
    """

    def both(batch: DataFrame) -> dict[str, DataFrame]:
        good, bad = split_rejects(stage(parse(batch), "parsed"))
        return {SCORED: score(good), REJECTS: bad}

    return both


def read_scored(spark: SparkSession, sink: str, like: DataFrame) -> DataFrame:
    """What has been scored so far: the rows of committed micro-batches, maybe none."""
    return StreamSink(spark, sink).read(SCORED, like)


def read_rejects(spark: SparkSession, sink: str, like: DataFrame) -> DataFrame:
    """The rows of committed micro-batches that could not be read, with their reasons."""
    return StreamSink(spark, sink).read(REJECTS, like)
