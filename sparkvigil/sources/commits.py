"""Small files that make what was written before them count: a folder of named, atomic commits.

Data goes to folders of its own first and is never changed there. A commit is one small JSON file that
names those folders; it is written under another name and then renamed, which happens as a whole or
not at all, and fails if the name is taken. A writer that breaks off leaves folders that no commit
names, and readers do not see them.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

LOG = "_commits"
DIGITS = 12


def hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    file_system(spark, path).delete(hadoop_path(spark, path), True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    return file_system(spark, path).getContentSummary(hadoop_path(spark, path)).getLength()


class CommitLog:
    """The commits below one root, by name."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.folder = f"{self.root}/{LOG}"

    def names(self) -> list[str]:
        """All committed names, sorted."""
        fs, place = file_system(self.spark, self.folder), hadoop_path(self.spark, self.folder)
        if not fs.exists(place):
            return []
        found = [status.getPath().getName() for status in fs.listStatus(place)]
        return sorted(n.removesuffix(".json") for n in found if n.endswith(".json") and n[0] not in "._")

    def read(self, name: str) -> dict:
        path = f"{self.folder}/{name}.json"
        stream = file_system(self.spark, path).open(hadoop_path(self.spark, path))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, name: str, content: dict) -> bool:
        """Whether the commit is now there by this call: False if the name was taken."""
        jvm, taken = self.spark._jvm, f"{self.folder}/{name}.json"
        aside = f"{self.folder}/.{name}-{uuid.uuid4().hex[:12]}.tmp"
        out = file_system(self.spark, aside).create(hadoop_path(self.spark, aside), True)
        out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            hadoop_path(self.spark, aside).toUri(), self.spark._jsc.hadoopConfiguration()
        )
        plain = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        if taken.rpartition("/")[2].removesuffix(".json") not in self.names():
            try:
                context.rename(hadoop_path(self.spark, aside), hadoop_path(self.spark, taken), plain)
                return True
            except Exception as error:  # only another writer's commit of this name is an outcome
                if "FileAlreadyExistsException" not in str(error):
                    raise
        remove(self.spark, aside)
        return False

    def drop(self, name: str) -> None:
        remove(self.spark, f"{self.folder}/{name}.json")


class Versions:
    """Numbered versions of one thing, the highest of which counts."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.log = CommitLog(spark, root)

    def numbers(self) -> list[int]:
        return [int(n) for n in self.log.names() if n.isdigit()]

    def newest(self) -> int | None:
        return max(self.numbers(), default=None)

    def new_folder(self) -> str:
        """A folder that no commit names yet, and no other writer uses."""
        return f"{self.log.root}/versions/{uuid.uuid4().hex}"

    def publish(self, folder: str, **content) -> int:
        """Commit a written folder as the next version."""
        while True:
            number = (self.newest() or 0) + 1
            if self.log.commit(f"{number:0{DIGITS}d}", {"folder": folder.rpartition("/")[2], **content}):
                return number

    def publish_after(self, seen: int | None, folder: str, **content) -> bool:
        """Commit a folder that was made from version ``seen``, unless a newer one came in between."""
        return self.log.commit(f"{(seen or 0) + 1:0{DIGITS}d}", {"folder": folder.rpartition("/")[2], **content})

    def content(self, number: int | None = None) -> dict | None:
        """The commit of a version, the newest by default, with its whole folder; None if there is none."""
        number = self.newest() if number is None else number
        if number is None:
            return None
        found = self.log.read(f"{number:0{DIGITS}d}")
        return {**found, "version": number, "folder": f"{self.log.root}/versions/{found['folder']}"}

    def keep(self, newest: int) -> None:
        """Remove all but the newest versions: first their commits, then their folders.

        Folders of unfinished writers stay: they may still be written to.
        """
        for number in sorted(self.numbers())[: -newest or None]:
            folder = self.content(number)["folder"]
            self.log.drop(f"{number:0{DIGITS}d}")
            remove(self.log.spark, folder)
