"""Rows in order without a task that holds a group, and digests of ordered texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from betaloom.llm.tokens import tidy
from betaloom.tables import materialize


def named(key: str) -> Column:
    """A key of any type as text that is never null, so that rows without a key are one group of their own."""
    return F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))


def unnamed(name: str, kind: str) -> Column:
    """The key that ``named`` was made from."""
    return F.when(F.col(name) != "", F.substring(name, 2, 1 << 30)).cast(kind)


def keyed(rows: DataFrame, label: str) -> DataFrame:
    """Write the rows with a number of their own, ``row_key``, which tells repeated rows apart."""
    return materialize(rows.withColumn("row_key", F.monotonically_increasing_id()), label)


def placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows sorted by range with ``place``, a number that grows in the order (nulls first) but has gaps.

    The last column of ``order`` must differ in every row: then a group of any size is dealt over many ranges. Write
    the result before it is used twice, as another run may draw other bounds.
    """
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())


def ordered_sha256(rows: DataFrame, key: str, order: Sequence[str], text: Column, between: str = "") -> DataFrame:
    """One row per ``key``: the digest of its texts in order, joined by ``between``.

    A digest needs its bytes in a row, so one task reads a key's texts; it streams them and holds a batch.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, digest = None, None
        for frame in frames:
            done = []
            for name, piece in zip(frame["key"], frame["piece"], strict=True):
                if digest is None or name != now:
                    if digest is not None:
                        done.append((now, digest.hexdigest()))
                    now, digest = name, hashlib.sha256()
                else:
                    digest.update(between.encode())
                digest.update(piece.encode())
            if done:
                yield pd.DataFrame(done, columns=["key", "sha256"])
        if digest is not None:
            yield pd.DataFrame([(now, digest.hexdigest())], columns=["key", "sha256"])

    sorted_rows = rows.select(F.col(key).alias("key"), *order, text.alias("piece")).repartition("key").sortWithinPartitions("key", *order)
    return sorted_rows.select("key", "piece").mapInPandas(tidy(run), "key string, sha256 string")
