"""Tables that streams append to, one commit for every micro-batch and all its outputs.

A micro-batch writes each of its outputs to a folder of its own and then commits their names under its
stream's id and its number. A micro-batch that runs again finds its commit and adds nothing; one that
broke off before its commit has left folders that are not part of the table. So rows are in each
output exactly once, and scored rows and rejects of a micro-batch appear together or not at all.

``compact`` folds what was committed into larger files and commits the list of all folders that count.
Folders have levels: when ``FAN`` folders of a level have gathered, they become one of the next, so a
row is rewritten about log(rows) times, a reader gets at most ``FAN`` folders of a level, and lists
only the commits since the last fold.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from sparkvigil.sources.commits import CommitLog, folder_bytes, remove

# Folders of one level that become one of the next; commits before a fold.
FAN = 8
FILE_BYTES = 128 << 20
# Most rows of a file: bytes do not bound them where columns compress well.
FILE_ROWS = 1_000_000


class StreamSink:
    """The outputs below one root."""

    def __init__(self, spark: SparkSession, root: str, fan: int = FAN, file_bytes: int = FILE_BYTES) -> None:
        self.spark, self.root, self.fan, self.file_bytes = spark, root.rstrip("/"), fan, file_bytes
        self.log = CommitLog(spark, root)

    # ---- state of the table

    def state(self) -> dict:
        """What counts now: ``folders`` {output: [[level, folder]]}, ``done`` {stream: last folded number},
        ``fold`` (its number) and ``batches``, the commits since."""
        names = self.log.names()
        folds = [n for n in names if n.startswith("fold-")]
        base = self.log.read(folds[-1]) if folds else {"folders": {}, "done": {}, "fold": 0}
        batches = []
        for name in names:
            if name.startswith("batch-"):
                _, stream, number = name.split("_")
                if int(number) > base["done"].get(stream, -1):
                    batches.append(self.log.read(name))
        folders = {o: [list(f) for f in found] for o, found in base["folders"].items()}
        for batch in batches:
            for output, folder in batch["outputs"].items():
                folders.setdefault(output, []).append([0, folder])
        return {**base, "folders": folders, "batches": batches}

    def paths(self, output: str) -> list[str]:
        return [f"{self.root}/{output}/{folder}" for _, folder in self.state()["folders"].get(output, [])]

    def read(self, output: str, like: DataFrame) -> DataFrame:
        """The rows of an output so far, maybe none."""
        paths = self.paths(output)
        if not paths:
            return self.spark.createDataFrame([], like.schema)
        return self.spark.read.schema(like.schema).parquet(*paths)

    # ---- appending

    def committed(self, stream: str, number: int) -> bool:
        state = self.state()
        return number <= state["done"].get(stream, -1) or any(
            b["stream"] == stream and b["number"] == number for b in state["batches"]
        )

    def append(self, stream: str, number: int, outputs: Mapping[str, DataFrame]) -> bool:
        """Write all outputs of a micro-batch and commit them; False if that was done before."""
        if self.committed(stream, number):
            return False
        written = {}
        for output, rows in outputs.items():
            written[output] = uuid.uuid4().hex
            rows.write.parquet(f"{self.root}/{output}/{written[output]}")
        name = f"batch-_{stream}_{number:012d}"
        return self.log.commit(name, {"stream": stream, "number": number, "outputs": written})

    # ---- folding

    def fold_when_due(self) -> bool:
        return len(self.state()["batches"]) >= self.fan and self.compact()

    def compact(self) -> bool:
        """Fold the commits since the last fold; False if there were none or another writer was first.

        Folders that were replaced by the fold before this one go now: whoever began to read them has
        had the time between two folds to finish.
        """
        state = self.state()
        if not state["batches"]:
            return False
        made, folders, replaced = [], {}, []
        for output, found in state["folders"].items():
            kept = found
            for level in range(max(lv for lv, _ in found) + 1):
                own = [f for lv, f in kept if lv == level]
                if level == 0 or len(own) >= self.fan:
                    merged = self.merged(output, own)
                    made += [f"{output}/{f}" for f in merged]
                    replaced += [f"{output}/{f}" for f in own]
                    kept = [x for x in kept if x[0] != level] + [[level + 1, f] for f in merged]
            folders[output] = kept
        done = dict(state["done"])
        for batch in state["batches"]:
            done[batch["stream"]] = max(done.get(batch["stream"], -1), batch["number"])
        number = state["fold"] + 1
        content = {"folders": folders, "done": done, "fold": number, "replaced": replaced}
        if not self.log.commit(f"fold-{number:012d}", content):
            for folder in made:
                remove(self.spark, f"{self.root}/{folder}")
            return False
        self.clean(number)
        return True

    def merged(self, output: str, folders: list[str]) -> list[str]:
        """One folder with the rows of several, in files of about ``file_bytes`` and at most about
        ``FILE_ROWS`` rows; none for none."""
        paths = [f"{self.root}/{output}/{f}" for f in folders]
        if not paths:
            return []
        rows = self.spark.read.parquet(*paths)
        size = sum(folder_bytes(self.spark, p) for p in paths)
        folder = uuid.uuid4().hex
        files = max(1, -(-size // self.file_bytes), -(-rows.count() // FILE_ROWS))
        rows.repartition(files).write.parquet(f"{self.root}/{output}/{folder}")
        return [folder]

    def clean(self, number: int) -> None:
        """Drop the fold before last, what the last one replaced, and the batch commits it covers."""
        if number < 2:
            return
        before = self.log.read(f"fold-{number - 1:012d}")
        for folder in before["replaced"]:
            remove(self.spark, f"{self.root}/{folder}")
        for name in self.log.names():
            if name.startswith("batch-"):
                _, stream, at = name.split("_")
                if int(at) <= before["done"].get(stream, -1):
                    self.log.drop(name)
            elif name.startswith("fold-") and int(name.removeprefix("fold-")) < number - 1:
                self.log.drop(name)
