"""Frame helpers that several operators share."""

from __future__ import annotations

import math
import os
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in ``spark.checkpoint.dir``. Only a local session, whose
    tasks all see the driver's disk, may do without one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return named or os.path.join(tempfile.gettempdir(), "glossmill-checkpoints")


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """``checkpoint()`` in the shared folder."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager)


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written once, as a table in the shared folder, and read again. Unlike with
    ``checkpoint()`` the last stage runs once. The table goes when the session ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/glossmill-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


class IdFilter:
    """A Bloom filter of ids: rows that it lets pass may be among them, all others are not.

    Its bits grow with the number of ids up to ``MOST_BITS``, 32 MB, whatever the table; beyond
    that it only lets more rows pass. It never decides by itself: what passes is joined as usual.
    """

    MOST_BITS = 1 << 28
    SEEDS = (3, 5)

    def __init__(self, ids: DataFrame, key: str) -> None:
        self.key = key
        self.bits = min(self.MOST_BITS, 1 << max(16, (16 * ids.count()).bit_length()))
        at = ids.select(F.explode(F.array(*self._places())).alias("at"))
        words = at.groupBy(F.shiftright("at", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("b"))
        got = words.toArrow()  # at most MOST_BITS / 64 rows
        table = np.zeros(self.bits // 64, np.uint64)
        table[got["w"].to_numpy()] = got["b"].to_numpy().view(np.uint64)
        self.table = ids.sparkSession.sparkContext.broadcast(table)

    def _places(self) -> list[Column]:
        return [F.pmod(F.xxhash64(F.col(self.key).cast("long"), F.lit(s)), F.lit(self.bits)) for s in self.SEEDS]

    def passing(self, docs: DataFrame, inside: bool = True) -> DataFrame:
        """Rows that may be among the ids, or with ``inside=False`` those that surely are not."""
        names, kinds = docs.columns, docs.dtypes
        shared = self.table

        def run(batches):
            table = shared.value
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for at in (c.to_numpy() for c in batch.columns[len(names) :]):
                    keep &= (table[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0
                if (keep if inside else ~keep).any():
                    yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep if inside else ~keep)) for c in batch.columns[: len(names)]], names)

        tested = docs.select("*", *(at.alias(f"_at{i}") for i, at in enumerate(self._places())))
        return tested.mapInArrow(run, ", ".join(f"`{c}` {kind}" for c, kind in kinds))


def text_bytes(docs: DataFrame, text: str) -> int:
    """Bytes of text in all rows: sets how many pieces work is dealt into, never what is kept."""
    return int(docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text)).cast("long")), F.lit(0)).alias("n")).first()["n"])


def pieces(total: float, each: float, least: int = 1) -> int:
    return max(least, math.ceil(total / each))


def dealt(docs: DataFrame, doc_id: str, text: str, n_chunks: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """(chunk, doc_id, text, carried columns): documents dealt to chunks by a hash of both.

    A chunk always holds the same rows, so a later pass can meet what an earlier one learnt of
    it; hot keys don't matter, as equal texts of different ids go to different chunks.
    """
    return docs.select(
        F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(n_chunks)).cast("int").alias("chunk"),
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        *(F.col(c) for c in carry),
    )


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


def spark_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


def fresh(name: str, taken: list[str] | tuple[str, ...]) -> str:
    """The name, lengthened until no column has it; Spark doesn't tell case apart."""
    held = {c.lower() for c in taken}
    while name.lower() in held:
        name += "_"
    return name
