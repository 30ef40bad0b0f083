"""Rows by their place in an order, for any place, without sorting the rows.

The key at a place is found by refining histograms: some pivots drawn from the
keys in question, one scan that counts the rows between them (a binary search
in nested CASEs, partial counts), and on with the stretch that holds the
place. Every round divides the stretch by about ``PIVOTS``; what is left of at
most ``FEW`` keys goes to the driver. Only key columns are read until then.
The rows themselves are taken by one range filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.operators.indexing import dense_index

PIVOTS = 15
FEW = 4096


def _value(row, fields) -> Column:
    return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)])


def _between(key: Column, low: Column | None, high: Column | None) -> Column:
    out = F.lit(True)
    out = out & (key > low) if low is not None else out
    return out & (key < high) if high is not None else out


def _slot(key: Column, pivots: list[Column], a: int, b: int) -> Column:
    """2 i + 1 at pivot i, 2 i before it (and behind the one before it)."""
    if a == b:
        return F.lit(2 * a)
    m = (a + b) // 2
    return (F.when(key == pivots[m], 2 * m + 1).when(key < pivots[m], _slot(key, pivots, a, m))
            .otherwise(_slot(key, pivots, m + 1, b)))


def key_at(keys: DataFrame, n: int):
    """(value of the struct column ``k`` at the 0-based place ``n``, rows
    before the first row with it, rows with it); None beyond the last row.
    Nulls come first."""
    fields = keys.schema["k"].dataType.fields
    k, low, high, before = F.col("k"), None, None, 0
    while True:
        here = keys.where(_between(k, low, high))
        rest = [r.k for r in here.limit(FEW + 1).orderBy("k").collect()]
        if len(rest) <= FEW:
            if n - before >= len(rest):
                return None
            found = rest[n - before]
            return found, before + rest.index(found), rest.count(found)
        drawn = here.orderBy(F.xxhash64("k", F.monotonically_increasing_id())).limit(PIVOTS).distinct().orderBy("k").collect()
        pivots = [_value(r.k, fields) for r in drawn]
        counts = dict(here.groupBy(_slot(k, pivots, 0, len(pivots)).alias("s")).agg(F.count(F.lit(1)).alias("n")).collect())
        for s in range(2 * len(pivots) + 1):
            if before + counts.get(s, 0) > n:
                break
            before += counts.get(s, 0)
        else:
            return None
        i = s // 2
        if s % 2:
            return drawn[i].k, before, counts[s]
        low, high = pivots[i - 1] if i else low, pivots[i] if i < len(pivots) else high


def rows_between(df: DataFrame, order: list[Column], start: int, stop: int | None) -> DataFrame:
    """The rows at the places ``start`` to ``stop`` (exclusive, None: the
    last) in ascending ``order``. Of rows that are equal in ``order`` any may
    come first; make it total for a fixed result."""
    if stop is not None and stop <= start:
        return df.limit(0)
    keyed = df.select(F.struct(*df.columns).alias("_row"), F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)]).alias("_key"))
    keys = keyed.select(F.col("_key").alias("k"))
    fields = keys.schema["k"].dataType.fields
    first = key_at(keys, start) if start else None
    if start and first is None:
        return df.limit(0)
    last = key_at(keys, stop) if stop is not None else None
    key = F.col("_key")
    cond = _between(key, _value(first[0], fields) if first else None, _value(last[0], fields) if last else None)
    parts = []
    # of the rows equal to an end of the stretch, those inside it
    for value, before, n in dict.fromkeys(e for e in (first, last) if e):
        a, b = max(start - before, 0), n if stop is None else min(stop - before, n)
        same = keyed.where(key == _value(value, fields))
        if a == 0 and b == n:
            cond = cond | (key == _value(value, fields))
        elif b > a:
            placed = dense_index(same.withColumn("_tie", F.monotonically_increasing_id()), ["_tie"], "_at")
            parts.append(placed.where((F.col("_at") >= a) & (F.col("_at") < b)))
    out = keyed.where(cond).select("_row.*")
    for p in parts:
        out = out.unionAll(p.select("_row.*"))
    return out
