"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from colloquy.session import checkpoint_root, delete_path, scratch_path

# a word is a run of characters other than the six ASCII white-space characters
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Words in ``text``; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def crc32_bucket(col: Column, n: int) -> Column:
    """``crc32(col as text) mod n``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")), F.lit(n).cast("long"))


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder (cuts lineage, computed once)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a compressed table in the shared folder, read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._scratch = path
    return table


def drop_stored(*tables: DataFrame, wait: float = 0.0) -> None:
    """Remove tables made by ``stored`` whose last reader is done, and the
    shuffle files of finished steps."""
    for df in tables:
        delete_path(df.sparkSession, df._scratch)
    free_shuffles(tables[0].sparkSession, wait)


def free_shuffles(spark: SparkSession, wait: float = 0.0) -> None:
    """Let Spark remove the shuffle files of finished steps: it does so when
    the driver's collector meets the objects that refer to them, which a large
    heap puts off for long. Events of the last step that no listener has seen
    yet still refer to its files; ``wait`` gives them so many seconds."""
    import gc
    import time

    time.sleep(wait)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def prefix_sums(df: DataFrame, group: str, order: list, values: dict[str, str]) -> DataFrame:
    """Exclusive running sums per group, without gathering a group in a task.

    ``group`` is a non-null column, ``order`` a list of columns, ``values``
    maps an input column to the name of its running sum. The rows are
    range-partitioned by (group, order), so a hot group spreads over many
    partitions; that layout is checkpointed (both passes must see the same
    one). Pass one totals each (partition, group); pass two sums inside the
    partition and adds the totals of the group's earlier partitions.
    """
    tagged = cut(df.repartitionByRange(F.col(group), *order).withColumn("_pid", F.spark_partition_id()))
    before = Window.partitionBy("_pid", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = tagged
    for v, out in values.items():
        inside = inside.withColumn(out, F.coalesce(F.sum(v).over(before), F.lit(0)))
    totals = tagged.groupBy("_pid", group).agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    earlier = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", group, *[F.coalesce(F.sum(f"_t_{v}").over(earlier), F.lit(0)).alias(f"_o_{v}")
                                             for v in values])
    joined = inside.join(offsets, ["_pid", group])
    for v, out in values.items():
        joined = joined.withColumn(out, F.col(out) + F.col(f"_o_{v}"))
    return joined.drop("_pid", *[f"_o_{v}" for v in values])


def append_columns(df: DataFrame, fn, added: str) -> DataFrame:
    """``df`` with columns computed from its ``text`` in Arrow batches.

    ``fn(list of texts) -> list of value lists``, one per column of the DDL
    string ``added``. The other columns pass through untouched; columns that
    have the new names are replaced.
    """
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    new = T.StructType.fromDDL(added)
    df = df.drop(*new.fieldNames())
    out = T.StructType(list(df.schema.fields) + list(new.fields))

    def run(batches):
        import pyarrow as pa

        kinds = [f.type for f in to_arrow_schema(new)]
        for batch in batches:
            for part in slices(batch):
                texts = part.column(part.schema.get_field_index("text")).to_pylist()
                values = [pa.array(v, k) for v, k in zip(fn(texts), kinds)]
                yield pa.RecordBatch.from_arrays([*part.columns, *values], names=[f.name for f in out.fields])

    return df.mapInArrow(run, out)


def slices(batch, rows: int = 512):
    for s in range(0, batch.num_rows, rows):
        yield batch.slice(s, rows)
