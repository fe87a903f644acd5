"""Helpers that the training-data operators share."""

from __future__ import annotations

import hashlib
import pickle
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.storage import discard, mapped, materialize, reads, shared_dir, ship

#: White space that ends a word: space and the characters tab to carriage return.
#: bytes.split() without arguments splits at exactly these, bytes.lower() lowers A-Z only.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo folds; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % folds


def free_name(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like the wanted ones that do not clash with columns of df, whatever their case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


class Shared:
    """A broadcast value of bounded size; workers keep what they build of it by a hash of its content."""

    def __init__(self, spark: SparkSession, value):
        data = pickle.dumps(value, 5)
        self.key = hashlib.sha256(data).hexdigest()
        self.sent = spark.sparkContext.broadcast(zlib.compress(data, 1))

    def built(self, make: Callable, keep: int = 2):
        """make(value), made once in a worker; it keeps the latest few."""
        key = (make.__module__, make.__qualname__, self.key)
        if key not in _BUILT:
            while len(_BUILT) >= keep:
                del _BUILT[next(iter(_BUILT))]
            _BUILT[key] = make(pickle.loads(zlib.decompress(self.sent.value)))
        return _BUILT[key]


_BUILT: dict = {}

__all__ = ["WORD", "Shared", "discard", "fold", "free_name", "mapped", "materialize", "reads", "shared_dir", "ship", "table"]
