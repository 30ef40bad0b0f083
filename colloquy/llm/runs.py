"""Pairs inside buckets, without gathering a bucket or emitting its pairs.

``blocks`` deals the rows of (bucket key) groups into block pairs: a bucket
of n rows is hashed into ceil(n / size) chunks, and each unordered pair of
chunks becomes one unit of at most ``2 * size`` rows or so. ``unit_runs``
then walks a sorted partition and hands out whole units.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def blocks(members: DataFrame, key: list[str], node: str, size: int,
           payload: DataFrame | None = None) -> DataFrame:
    """Members of buckets with at least two rows, with unit columns ``_i``,
    ``_j`` (chunk pair, _i <= _j) and the row's own chunk ``_c``; rows of a
    unit lie together and in order within a partition. ``payload``: columns
    to add by ``node``, only to members that have a partner."""
    counts = (members.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
              .withColumn("_chunks", F.ceil(F.col("_n") / F.lit(size)).cast("int")).drop("_n"))
    rows = members.join(counts, key)
    if payload is not None:
        rows = rows.join(payload, node)
    rows = rows.withColumn("_c", F.pmod(F.xxhash64(node, F.lit(7)), F.col("_chunks").cast("long")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))
    units = (rows.withColumn("_o", other).withColumn("_i", F.least("_c", "_o")).withColumn("_j", F.greatest("_c", "_o"))
             .drop("_o", "_chunks"))
    return units.repartition(*key, "_i", "_j").sortWithinPartitions(*key, "_i", "_j")


def unit_runs(batches: Iterator[pd.DataFrame], key: list[str]) -> Iterator[pd.DataFrame]:
    """Frames that hold whole units only, cut from a sorted partition: each
    batch is joined to the open unit before it and split at its last unit."""
    rest = None
    for pdf in batches:
        if not len(pdf):
            continue
        if rest is not None:
            pdf = pd.concat([rest, pdf], ignore_index=True)
        last = (pdf[key] == pdf[key].iloc[-1]).all(axis=1).to_numpy()
        head = int(len(pdf) - last[::-1].argmin()) if not last.all() else 0
        if head:
            yield pdf.iloc[:head]
        rest = pdf.iloc[head:]
    if rest is not None and len(rest):
        yield rest


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row of each row's component under the links (a, b)."""
    lab = np.arange(n)
    while True:
        m = np.minimum(lab[a], lab[b])
        new = lab.copy()
        np.minimum.at(new, lab[a], m)
        np.minimum.at(new, lab[b], m)
        new = new[new]
        if (new == lab).all():
            return lab
        lab = new
