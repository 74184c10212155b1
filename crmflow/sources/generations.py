"""What a stored table consists of at one moment: numbered manifests, the highest of which counts.

Files of a table are written to new folders and never changed. A manifest names the folders that make
up the table; it appears by one rename that fails if its number is taken. So a reader sees one whole
generation, a writer that dies leaves the one before, and of two writers the second starts over.
The rename must be atomic, as in HDFS; manifests hold names of folders, never rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import SparkSession

_FOLDER = "_generations"


class Taken(RuntimeError):
    """Other writers published first, again and again."""


class Generations:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, *parts: str):
        return self._hadoop.Path("/".join((self.path, *parts)))

    def _fs(self):
        return self._at().getFileSystem(self._conf)

    def names(self, *parts: str) -> list[str]:
        """Names in a folder of the table; none if it does not exist."""
        fs, at = self._fs(), self._at(*parts)
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def numbers(self) -> list[int]:
        return [int(n[:-5]) for n in self.names(_FOLDER) if n.endswith(".json") and n[:-5].isdigit()]

    def read(self, number: int) -> dict:
        stream = self._fs().open(self._at(_FOLDER, f"{number:012d}.json"))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def current(self) -> tuple[int, dict | None]:
        """Number and content of the newest manifest; (-1, None) before the first."""
        numbers = self.numbers()
        return (max(numbers), self.read(max(numbers))) if numbers else (-1, None)

    def publish(self, number: int, content: dict) -> bool:
        """Make ``content`` generation ``number``; False if another writer has it already."""
        jvm, fs = self.spark.sparkContext._jvm, self._fs()
        draft, final = self._at(_FOLDER, f".{uuid.uuid4().hex}"), self._at(_FOLDER, f"{number:012d}.json")
        if fs.exists(final):
            return False
        out = fs.create(draft)
        try:
            out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
        finally:
            out.close()
        context = self._hadoop.FileContext.getFileContext(final.toUri() if final.toUri().getScheme() else fs.getUri(), self._conf)
        rename = jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs.Options, "Rename"), 1)
        options[0] = jvm.java.lang.Enum.valueOf(rename, "NONE")
        try:
            context.rename(fs.makeQualified(draft), fs.makeQualified(final), options)
        except Exception as failed:  # py4j wraps every Java exception in its own
            if fs.exists(final):
                fs.delete(draft, False)
                return False
            raise failed
        return True

    def update(self, change: Callable[[dict | None], dict | None], attempts: int = 20) -> dict | None:
        """Publish ``change(content)``, starting over from the newest content if another writer was first.

        ``change`` returning None publishes nothing.
        """
        for _ in range(attempts):
            number, content = self.current()
            wanted = change(content)
            if wanted is None:
                return content
            if self.publish(number + 1, wanted):
                return wanted
        raise Taken(f"{self.path}: {attempts} times another writer was first")

    def clean(self, used: Callable[[dict], Iterable[str]], folder: str, keep: int = 2) -> int:
        """Delete folders below ``folder`` that none of the last ``keep`` generations uses; returns how many.

        ``keep`` generations stay for readers that began before the newest was published. Folders of a write
        that is not published yet are named by no generation, so only one writer may clean, between its writes.
        """
        numbers = sorted(self.numbers())
        held = {name for n in numbers[-keep:] for name in used(self.read(n))}
        fs, dropped = self._fs(), 0
        for name in self.names(folder):
            if name not in held:
                fs.delete(self._at(folder, name), True)
                dropped += 1
        for n in numbers[:-keep]:
            fs.delete(self._at(_FOLDER, f"{n:012d}.json"), False)
        return dropped


def with_batch(ranges: list[list[int]], batch_id: int) -> list[list[int]]:
    """Batch ids as sorted [first, last] ranges with one more id."""
    merged: list[list[int]] = []
    for first, last in sorted([*ranges, [batch_id, batch_id]]):
        if merged and first <= merged[-1][1] + 1:
            merged[-1][1] = max(last, merged[-1][1])
        else:
            merged.append([first, last])
    return merged


def has_batch(ranges: list[list[int]], batch_id: int) -> bool:
    return any(first <= batch_id <= last for first, last in ranges)
