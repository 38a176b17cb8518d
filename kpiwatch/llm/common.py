"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

#: Odd 64-bit multipliers, one for each word of a shingle.
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`, also set as the checkpoint folder.

    Where that is unset, a local session (tests) gets a scratch one; on a cluster it is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        if shared := spark.conf.get("spark.checkpoint.dir", None):
            sc.setCheckpointDir(shared)
        elif sc.master.startswith("local[") or sc.master == "local":
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """`df` written once to the shared checkpoint folder, so that later steps never recompute it."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


class Hashes(dict):
    """64-bit hash of each word (bytes), remembered up to `most` words at a time."""

    def __init__(self, most: int = 400_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Places:
    """Where values stand among sorted 64-bit hashes: their first bits tell about where, a few steps the rest."""

    def __init__(self, hashes: np.ndarray, bits: int = 16):
        self.hashes, self.shift = hashes, np.uint64(64 - bits)
        self.begins = np.searchsorted(hashes, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)
        self.steps = int(np.diff(self.begins, append=len(hashes)).max()) - 1

    def of(self, x: np.ndarray) -> np.ndarray:
        """The place of each value; that of any hash, if it isn't there. There must be hashes."""
        spot = np.minimum(self.begins[(x >> self.shift).astype(np.int64)], len(self.hashes) - 1)
        for _ in range(self.steps):
            spot += self.hashes[spot] < x
            np.minimum(spot, len(self.hashes) - 1, out=spot)
        return spot


def texts(batch: pa.RecordBatch, column: str = "text") -> Iterator[bytes]:
    """Each row's text as UTF-8 bytes, one at a time; null is empty."""
    for value in batch.column(column):
        yield (value.as_py() or "").encode("utf-8", "surrogatepass")
