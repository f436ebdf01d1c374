"""Keyed tables that a stream merges into, a batch reading and writing only the buckets it touches.

A table is a folder: rows lie in buckets by the hash of their key, each bucket in folders by version, and a
pointer for each version says which folder of every bucket is current. A batch reads its own buckets,
writes them anew beside the old and then puts its pointer in place with one rename, which fails if another
writer came first. So readers see a batch whole or not at all, a batch that is run again changes nothing, and
its cost follows the buckets that it touches, not the table.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmill.operators.quality import Violation

BUCKETS = 64


class Table:
    """``key``: the column that tells rows apart; ``schema``: of the rows, as a string."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema: str, buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.key, self.schema = spark, path.rstrip("/"), key, schema
        jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
        self._at = jvm.org.apache.hadoop.fs.Path
        self._fs = self._at(path).getFileSystem(conf)
        self._files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf)
        self._options = jvm.org.apache.hadoop.fs.Options.Rename
        held = self.pointer()
        self.buckets = held["buckets"] if held else buckets

    # --- versions ---

    def _numbers(self) -> list[int]:
        where = self._at(f"{self.path}/_versions")
        names = [s.getPath().getName() for s in self._fs.listStatus(where)] if self._fs.exists(where) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def pointer(self, number: int | None = None) -> dict | None:
        """The current version, or a given one: its number, the batch it took in, and each bucket's folder."""
        numbers = self._numbers()
        if not numbers:
            return None
        stream = self._fs.open(self._at(f"{self.path}/_versions/{(numbers[-1] if number is None else number):020d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _commit(self, pointer: dict) -> None:
        name = f"{self.path}/_versions/{pointer['version']:020d}.json"
        part = self._at(f"{self.path}/_versions/.{self.spark._jvm.java.util.UUID.randomUUID()}.part")
        out = self._fs.create(part, False)
        out.write(json.dumps(pointer, sort_keys=True).encode())
        out.close()
        none = self.spark.sparkContext._gateway.new_array(self._options, 1)
        none[0] = self._options.NONE
        try:
            self._files.rename(self._fs.makeQualified(part), self._fs.makeQualified(self._at(name)), none)
        except Exception as error:
            self._fs.delete(part, False)
            if "FileAlreadyExists" in str(error):
                raise Violation(f"{self.path} was changed by another writer") from None
            raise

    # --- rows ---

    def _bucket(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("_bucket", F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int"))

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/{f}" for f in folders))

    def read(self) -> DataFrame:
        held = self.pointer()
        return self._read(sorted(held["folders"].values()) if held else [])

    def merge(self, batch: DataFrame, number: int, later_wins: bool = False, order: str | None = None) -> list[int]:
        """Takes in a numbered batch; returns the buckets that it touched, none if it was taken in before.

        Of rows with one key the table's wins, or with ``later_wins`` the batch's; within the batch the first by
        ``order`` (the last, if later ones win), or any.
        """
        held = self.pointer() or {"version": -1, "batch": -1, "folders": {}}
        if number <= held["batch"]:
            return []
        names = self.spark.createDataFrame([], self.schema).columns
        rows = batch.select(*dict.fromkeys((*names, *([order] if order else []))))
        row = F.struct(*names)
        one = F.any_value(row) if order is None else F.max_by(row, order) if later_wins else F.min_by(row, order)
        new = self._bucket(rows.groupBy(self.key).agg(one.alias("_r")).select("_r.*"))
        touched = sorted(r["_bucket"] for r in self._bucket(rows).select("_bucket").distinct().collect())  # at most BUCKETS
        old = self._bucket(self._read([held["folders"][str(b)] for b in touched if str(b) in held["folders"]]))
        first, second = (new, old) if later_wins else (old, new)
        merged = first.unionByName(second.join(first.select(self.key), self.key, "left_anti").select(*first.columns))
        version = held["version"] + 1
        folder = f"v{version:08d}-{self.spark._jvm.java.util.UUID.randomUUID()}"
        merged.repartition(len(touched) or 1, "_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
        folders = held["folders"] | {str(b): f"{folder}/_bucket={b}" for b in touched}
        self._commit({"version": version, "batch": number, "buckets": self.buckets, "folders": folders})
        return touched

    def sink(self, later_wins: bool = False, order: str | None = None):
        """A foreachBatch function."""

        def run(batch: DataFrame, number: int) -> None:
            self.merge(batch, number, later_wins, order)

        return run

    def release(self, keep: int = 2) -> int:
        """Removes what none of the last ``keep`` versions holds; returns how many folders went."""
        numbers = self._numbers()
        held = {f for n in numbers[-keep:] for f in self.pointer(n)["folders"].values()}
        gone = 0
        for top in self._fs.listStatus(self._at(self.path)):
            name = top.getPath().getName()
            if not name.startswith("v"):
                continue
            for part in self._fs.listStatus(top.getPath()):
                if part.isDirectory() and f"{name}/{part.getPath().getName()}" not in held:
                    self._fs.delete(part.getPath(), True)
                    gone += 1
        for n in numbers[:-keep]:
            self._fs.delete(self._at(f"{self.path}/_versions/{n:020d}.json"), False)
        return gone
