"""Versions of a set of tables: rows in folders that never change, and numbered commits that say which folders are whose.

A run writes folders of its own and then one commit, which has all its tables or none; readers keep to the commit that they
have read. A table may have several folders, so that one that only grows isn't written again. A commit that another run
has made meanwhile is an error, and so is nothing lost of either."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Commits whose folders are kept, for readers that still use them, and folders of a table from which on it is written anew.
KEEP, MANY = 2, 32
State = dict[str, list[str]]


class Versions:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{path}")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def numbers(self) -> list[int]:
        fs, p = self._fs("_commits")
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n[:-5]) for n in names if re.fullmatch(r"\d{10}\.json", n))

    def read(self, number: int) -> State:
        return json.loads(self.spark.read.text(f"{self.root}/_commits/{number:010d}.json", wholetext=True).first()[0]) if number else {}

    def latest(self) -> tuple[int, State]:
        number = max(self.numbers(), default=0)
        return number, self.read(number)

    def folder(self, name: str) -> str:
        return f"_data/{name}-{uuid.uuid4().hex}"

    def table(self, folders: list[str]) -> DataFrame:
        return self.spark.read.option("mergeSchema", str(len(folders) > 1).lower()).parquet(*[f"{self.root}/{f}" for f in folders])

    def commit(self, base: int, state: State) -> int:
        """The state as the commit behind base. It is written beside and renamed, so it is there as a whole."""
        number = base + 1
        fs, beside = self._fs(f"_commits/.{uuid.uuid4().hex}")
        out = fs.create(beside, False)
        out.write(bytearray(json.dumps(state, indent=1).encode()))
        out.close()
        _, target = self._fs(f"_commits/{number:010d}.json")
        if fs.exists(target) or not fs.rename(beside, target):
            fs.delete(beside, False)
            raise RuntimeError(f"another run has committed {number} in {self.root} meanwhile; run again")
        self._clean(number, state)
        return number

    def delete(self, folder: str) -> None:
        fs, p = self._fs(folder)
        fs.delete(p, True)

    def _clean(self, number: int, state: State) -> None:
        """Commits before the last KEEP go, with the folders that only they have."""
        old = [n for n in self.numbers() if n <= number - KEEP]
        kept = {f for n in self.numbers() if n > number - KEEP for fs in (state if n == number else self.read(n)).values() for f in fs}
        for n in old:
            for f in {f for fs in self.read(n).values() for f in fs} - kept:
                self.delete(f)
            self.delete(f"_commits/{n:010d}.json")
