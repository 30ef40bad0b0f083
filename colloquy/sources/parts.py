"""Multi-part file sets, artifact sizes, record files, logs."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# the first part of a set: number 0 or 1 and the number of parts, five digits each
FIRST_PART = r"(?s)^(.*)0000([01])-of-(\d{5})(.*)$"


def expand_parts_py(path: str) -> list[str]:
    """S4 on a path parameter: all parts of the set whose first part is
    ``path``, numbered from 1 or from 0 as it is; no existence check. Any
    other path is returned as is."""
    found = re.match(FIRST_PART, path)
    if not found:
        return [path]
    head, first, count, tail = found.groups()
    return [f"{head}{int(first) + k:05d}-of-{count}{tail}" for k in range(int(count))]


def zero_pad5(i) -> Column:
    """Python ``f"{i:05d}"`` for non-negative ints (lpad alone would truncate)."""
    i = _c(i)
    return F.when(i < 100000, F.lpad(i.cast("string"), 5, "0")).otherwise(i.cast("string"))


def parse_part_path(path) -> Column:
    """``STRUCT<prefix, last, suffix, lo, hi, ok, path>`` of a path: the parts
    of its set are numbered ``lo`` to ``hi``; ``ok`` is false for a path that
    is not the first part of a set."""
    p = _c(path)
    group = lambda k: F.regexp_extract(p, FIRST_PART, k)
    lo = group(2).try_cast("int")
    return F.struct(group(1).alias("prefix"), group(3).alias("last"), group(4).alias("suffix"), lo.alias("lo"),
                    (group(3).try_cast("int") + lo - 1).alias("hi"), p.rlike(FIRST_PART).alias("ok"), p.alias("path"))


def expand_parsed(pp) -> Column:
    """Part paths from a :func:`parse_part_path` struct."""
    pp = _c(pp)
    lo = F.coalesce(pp["lo"], F.lit(0))
    parts = F.transform(F.sequence(lo, F.greatest(pp["hi"], lo)), lambda i: F.concat(
        pp["prefix"], zero_pad5(i), F.lit("-of-"), pp["last"], pp["suffix"]))
    parts = F.when(pp["hi"] >= pp["lo"], parts).otherwise(F.array().cast("array<string>"))
    return F.when(pp["ok"], parts).otherwise(F.array(pp["path"]))


def expand_parts(path) -> Column:
    """S4 as a Column: ``ARRAY<STRING>`` of all part paths of each row."""
    return expand_parsed(parse_part_path(path))


def missing_parts(first_paths: DataFrame, listing: DataFrame, path: str = "path") -> DataFrame:
    """S4 completeness: expected parts (``sequence`` + ``explode``) LEFT ANTI the listing.

    The path is parsed once in its own projection, then expanded.
    """
    parsed = first_paths.select(parse_part_path(path).alias("_pp"))
    expected = parsed.select(F.explode(expand_parsed("_pp")).alias(path))
    return expected.join(listing.select(path), path, "left_anti")


def read_parts(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """S4 + S6: read every part of a multi-part set as one DataFrame."""
    return spark.read.format(fmt).load(expand_parts_py(path))


def strip_part_suffix(path) -> Column:
    """``x-00002-of-00003.gguf`` -> ``x.gguf`` (key for summing part sizes)."""
    return F.regexp_replace(_c(path), r"-\d{5}-of-\d{5}", "")


def artifact_sizes(spark: SparkSession, pattern: str, name: Column | None = None) -> DataFrame:
    """Byte size of each artifact = sum over its parts. ``name``: the part
    name within ``path``, the whole path by default.

    ``binaryFile`` with only ``path`` and ``length`` selected lists file
    metadata and never reads file contents.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(pattern).select("path", "length")
    return (files.groupBy(strip_part_suffix(F.col("path") if name is None else name).alias("artifact"))
            .agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("bytes")))


def read_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """S6 + U1: records of Parquet or JSON files, by-name union; other extensions raise."""
    frames = []
    for p in paths:
        if p.endswith("parquet"):
            frames.append(spark.read.parquet(p))
        elif p.endswith("json"):
            frames.append(spark.read.option("multiLine", True).json(p))
        else:
            raise ValueError(f"neither a json nor a parquet file: {p}")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def write_json_array(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Record files for S6: one JSON array document per partition.

    Rows become JSON objects in the JVM (``to_json``); a per-partition
    ``mapInPandas`` only frames them as ``[``, ``,``-prefixed records and
    ``]``, streaming batch by batch, and the text writer keeps that order.
    Empty partitions write no file; an entirely empty input leaves the
    writer's single empty file, which Spark reads as no records.
    """
    import pandas as pd

    objs = df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("j"))

    def frame(batches):
        first = True
        for pdf in batches:
            if len(pdf) == 0:
                continue
            lines = [("[" if (first and i == 0) else ",") + j for i, j in enumerate(pdf["j"])]
            first = False
            yield pd.DataFrame({"value": lines})
        yield pd.DataFrame({"value": ["[]" if first else "]"]})

    objs.mapInPandas(frame, "value string").write.mode(mode).text(path)


# Separator between logs when many runs share a file (ASCII record separator).
LOG_RECORD_SEP = "\u001e"


def read_logs(spark: SparkSession, pattern: str, record_sep: str | None = None) -> DataFrame:
    """Scorer logs as (path, log).

    Default: one row per file, the whole text of one run. With
    ``record_sep`` a file holds many runs, one per separated record, so each
    row is still one whole log while files stay few and large.
    """
    if record_sep is None:
        raw = spark.read.text(pattern, wholetext=True)
    else:
        raw = spark.read.option("lineSep", record_sep).text(pattern)
    return raw.select(F.input_file_name().alias("path"), F.col("value").alias("log"))


def write_logs(df: DataFrame, path: str, log: str = "log", record_sep: str = LOG_RECORD_SEP) -> None:
    """Write whole logs, one record each, separated by ``record_sep``."""
    df.select(log).write.mode("overwrite").option("lineSep", record_sep).text(path)
