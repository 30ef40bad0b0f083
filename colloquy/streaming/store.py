"""A table of latest rows by key that streams keep up to date.

Rows lie in buckets by key hash. A micro-batch adds one small delta to each
bucket it touches, and nothing else is written; readers take the latest row of
each key over a bucket's parts. When a bucket has gathered ``max_parts`` parts,
the newest are compacted into one, up to the first part that took in more
batches than all newer ones together: a large old part is not written again for
a few small deltas. A manifest lists the parts of every bucket; it is
written last and counts once Spark has committed it, so a batch shows as a
whole or not at all. Parts are never changed after that. The manifests before
the last two go, and with them the parts that none of the two lists.

    <store>/data/<batch>/bucket=<b>/       deltas of a batch
    <store>/data/<batch>-compact-<n>/bucket=<b>/      n deltas in one
    <store>/manifest/<batch>/              bucket, parts (oldest first)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from colloquy.session import delete_path

KEPT = 2  # manifests: the one being read when the next is published stays whole
_MANIFEST = "bucket int, parts array<string>, n_buckets int, keys array<string>"


def _names(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(root)) if fs.exists(root) else []


def _committed(spark: SparkSession, store: str) -> list[str]:
    """Published batches, oldest first."""
    return [n for n in _names(spark, f"{store}/manifest") if "_SUCCESS" in _names(spark, f"{store}/manifest/{n}")]


def _listed(spark: SparkSession, store: str, name: str) -> list[Row]:
    return spark.read.schema(_MANIFEST).json(f"{store}/manifest/{name}").collect()  # one row a bucket


def _manifest(spark: SparkSession, store: str, name: str) -> dict[int, list[str]]:
    return {r.bucket: list(r.parts) for r in _listed(spark, store, name)}


def _deltas(part: str) -> int:
    """How many deltas a part has taken in."""
    _, compact, n = part.partition("-compact-")
    return int(n) if compact else 1


def _kept(parts: list[str]) -> int:
    """How many parts, from the oldest on, a compaction leaves as they are."""
    newer = 0
    for k in range(len(parts) - 1, -1, -1):
        if len(parts) - 1 - k >= 2 and _deltas(parts[k]) > newer:
            return k + 1
        newer += _deltas(parts[k])
    return 0


def _latest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The row of greatest (version, batch) of each key; rows without a
    version lose to all others."""
    rest = [c for c in rows.columns if c not in keys]
    rank = F.struct(F.col("_version").isNotNull(), "_version", "_batch")
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_row")).select(*keys, "_row.*")


def upsert(batch: DataFrame, batch_id: int, store: str, keys: Sequence[str], version: Column | str | None = None,
           n_buckets: int = 64, max_parts: int = 8) -> None:
    """Publish ``batch`` as batch ``batch_id``: of every key the row of the
    highest ``version`` stays (of the latest batch when versions are equal or
    None). A batch that was published before is left as it is, so a replay
    changes nothing; a failed one leaves the last published table readable."""
    spark, keys, name = batch.sparkSession, list(keys), f"{batch_id:010d}"
    done = _committed(spark, store)
    if name in done:
        return
    done = [n for n in done if n < name]
    listed = _listed(spark, store, done[-1]) if done else []
    if listed and (listed[0].n_buckets != n_buckets or list(listed[0]["keys"]) != keys):
        raise ValueError(f"the store has {listed[0].n_buckets} buckets by {list(listed[0]['keys'])}")
    before = {r.bucket: list(r.parts) for r in listed}
    parts = {b: list(p) for b, p in before.items()}
    ver = F.lit(None).cast("long") if version is None else F.col(version) if isinstance(version, str) else version
    rows = batch.withColumns({"_version": ver, "_batch": F.lit(batch_id).cast("long")})
    delta = f"{store}/data/{name}"
    _write(_latest(rows, keys), delta, keys, n_buckets)
    for b in _buckets(spark, delta):
        parts.setdefault(b, []).append(name)
    due: dict[str, list[int]] = {}  # compacted part -> buckets
    old = []
    for b, p in parts.items():
        if len(p) >= max_parts:
            kept = _kept(p)
            due.setdefault(f"{name}-compact-{sum(map(_deltas, p[kept:]))}", []).append(b)
            old += [(b, x) for x in p[kept:]]
    for compact, full in due.items():
        these = [f"{store}/data/{x}/bucket={b}" for b, x in old if b in set(full)]
        _write(_latest(spark.read.schema(rows.schema).parquet(*these), keys), f"{store}/data/{compact}", keys, n_buckets)
        parts |= {b: [*parts[b][:_kept(parts[b])], compact] for b in full}
    table = [(b, p, n_buckets, keys) for b, p in sorted(parts.items())]
    spark.createDataFrame(table, _MANIFEST).coalesce(1).write.mode("overwrite").json(f"{store}/manifest/{name}")
    for b in [b for full in due.values() for b in full]:  # this batch's own deltas that went into a compacted part were never listed
        delete_path(spark, f"{delta}/bucket={b}")
    _clean(spark, store, [*done, name], {name: parts, **({done[-1]: before} if done else {})})


def _write(rows: DataFrame, path: str, keys: list[str], n_buckets: int) -> None:
    bucket = F.pmod(F.xxhash64(*keys), F.lit(n_buckets).cast("long")).cast("int")
    rows.withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)


def _buckets(spark: SparkSession, path: str) -> list[int]:
    return [int(n[len("bucket="):]) for n in _names(spark, path) if n.startswith("bucket=")]


def _clean(spark: SparkSession, store: str, done: list[str], known: dict[str, dict[int, list[str]]]) -> None:
    gone, kept = done[:-KEPT], done[-KEPT:]
    used = {(p, b) for n in kept for b, parts in (known[n] if n in known else _manifest(spark, store, n)).items() for p in parts}
    for n in gone:
        for b, parts in _manifest(spark, store, n).items():
            for p in parts:
                if (p, b) not in used:
                    delete_path(spark, f"{store}/data/{p}/bucket={b}")
        delete_path(spark, f"{store}/manifest/{n}")


def read_store(spark: SparkSession, store: str) -> DataFrame | None:
    """The table as last published (None before the first batch with rows)."""
    done = _committed(spark, store)
    if not done:
        return None
    rows = spark.read.schema(_MANIFEST).json(f"{store}/manifest/{done[-1]}").collect()
    paths = [f"{store}/data/{p}/bucket={r.bucket}" for r in rows for p in r.parts]
    if not paths:
        return None
    return _latest(spark.read.parquet(*paths), list(rows[0]["keys"])).drop("_version", "_batch")
