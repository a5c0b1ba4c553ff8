"""A table kept by key: each batch replaces the rows of the keys that it brings.

The rows lie in hash buckets of the key.  A batch rewrites the buckets of its own keys only, each into
a folder ``batch=n/bucket=b`` of its own, and then puts down a commit file that names the folder of
every bucket.  So

* other buckets' files stay as they are, whatever the size of the table,
* readers see whole batches: they go by the newest commit file,
* a batch that is repeated, after a failure or a restart, starts from the commit before it and
  overwrites its own folder, and gives the same table.

Folders that no commit names any more stay until :func:`drop_superseded`.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.maintenance import replace_by_key

BUCKETS = 64
_BUCKET = "_bucket"


def bucket_of(key: str, buckets: int) -> Column:
    """Bucket of a key by its text form, in which keys are compared; NULL has a bucket too."""
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


class KeyedTable:
    """The table at ``target``; ``buckets`` holds for a new table, an old one must have as many."""

    def __init__(self, spark: SparkSession, target: str, key: str, buckets: int = BUCKETS):
        self.spark, self.target, self.key, self.buckets = spark, target, key, buckets
        self._jvm = spark.sparkContext._jvm
        path = self._path(target)
        self._files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _place(self) -> Column:
        return bucket_of(self.key, self.buckets)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def commits(self) -> list[int]:
        """Numbers of the finished batches, ascending."""
        folder = self._path(f"{self.target}/_commits")
        if not self._files.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def _commit(self, number: int) -> dict[int, int]:
        """Batch whose folder holds each bucket, as of a finished batch."""
        path = self._path(f"{self.target}/_commits/{number}")
        text = self._jvm.org.apache.commons.io.IOUtils.toString(self._files.open(path), "UTF-8")
        found = json.loads(text)
        if (found["key"], found["buckets"]) != (self.key, self.buckets):
            raise ValueError(f"{self.target} has {found['buckets']} buckets by {found['key']}, not {self.buckets} by {self.key}")
        return {int(b): n for b, n in found["batch_of"].items()}

    def _write_commit(self, number: int, batch_of: dict[int, int]) -> None:
        """Written beside and renamed, so that a commit file is whole or not there."""
        text = json.dumps({"key": self.key, "buckets": self.buckets, "batch_of": batch_of}, sort_keys=True)
        unfinished, path = self._path(f"{self.target}/_commits/.{number}"), self._path(f"{self.target}/_commits/{number}")
        out = self._files.create(unfinished, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self._files.delete(path, False)
        if not self._files.rename(unfinished, path):
            raise OSError(f"commit {path} could not be put in place")

    def _at(self, before: int | None) -> dict[int, int]:
        numbers = [n for n in self.commits() if before is None or n < before]
        return self._commit(numbers[-1]) if numbers else {}

    def _rows(self, batch_of: dict[int, int]) -> DataFrame | None:
        paths = [f"{self.target}/batch={n}/{_BUCKET}={b}" for b, n in sorted(batch_of.items())]
        return self.spark.read.parquet(*paths) if paths else None

    def read(self, before: int | None = None) -> DataFrame | None:
        """The table after its newest batch, or after the newest one below ``before``; None if there is none."""
        return self._rows(self._at(before))

    def replace(self, batch: DataFrame, number: int) -> None:
        """Replace the batch's keys; batch ``number`` counts once, however often it comes."""
        table = self._at(number)
        placed = batch.withColumn(_BUCKET, self._place())
        touched = sorted(r[0] for r in placed.select(_BUCKET).distinct().collect())  # at most the number of buckets
        current = self._rows({b: table[b] for b in touched if b in table})
        if touched:
            rows = batch if current is None else replace_by_key(current, batch, self.key)
            # One file a bucket, or several where a bucket is large.
            spread = rows.withColumn(_BUCKET, self._place()).hint("rebalance", _BUCKET)
            spread.write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{self.target}/batch={number}")
        self._write_commit(number, table | dict.fromkeys(touched, number))

    def drop_superseded(self, keep: int = 1) -> int:
        """Delete the bucket folders that none of the ``keep`` newest commits names; returns how many.

        Keep as many commits as readers may still be reading; the older commit files go as well.
        """
        if keep < 1:
            raise ValueError("the newest commit has to stay")
        numbers = self.commits()
        if not numbers:
            return 0
        used = {(n, b) for number in numbers[-keep:] for b, n in self._commit(number).items()}
        dropped = 0
        for number in numbers:
            folder = self._path(f"{self.target}/batch={number}")
            if not self._files.exists(folder):
                continue
            for status in self._files.listStatus(folder):
                name = status.getPath().getName()
                if name.startswith(f"{_BUCKET}=") and (number, int(name.split("=")[1])) not in used:
                    dropped += self._files.delete(status.getPath(), True)
        for number in numbers[:-keep]:
            self._files.delete(self._path(f"{self.target}/_commits/{number}"), False)
        return dropped
