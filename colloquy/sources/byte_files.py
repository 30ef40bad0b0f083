"""Files of any bytes through Spark's own readers and writers.

Spark reads and writes text in ranges, on every file system it knows and with
its commit protocol. With the zero byte as line separator a "line" is a run
of other bytes, so text files carry any bytes without change: reading, the
runs of a split and the separators between them are its bytes, and the sums of
their lengths tell where a split begins; writing, a stream is cut at zero
bytes. A run is at most as long as the longest stretch without a zero byte.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BOM = b"\xef\xbb\xbf"  # a line reader leaves this out at the begin of a file
WINDOW = 4 << 20
SLICE = 2 << 20  # bytes that a Python function turns into objects at once


def slices(batches: Iterator[pa.RecordBatch], most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``most`` bytes, of one row at least:
    Spark's batches hold up to 64 MB, and a task has several of these
    functions, so that copies of whole batches add up."""
    for batch in batches:
        rows = max(1, int(most * batch.num_rows / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _source(spark: SparkSession, fmt: str, path: str) -> DataFrame:
    reader = spark.read.format(fmt).option("recursiveFileLookup", "true")
    return (reader.option("lineSep", "\0") if fmt == "text" else reader).load(path)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, size) of every file at ``path`` (a file, folder or pattern);
    raises if there is none. Spark's scans pass over files without bytes, so
    the names come from its file index, which the driver holds anyhow."""
    source = _source(spark, "binaryFile", path)
    names = source.inputFiles()
    if not names:
        raise FileNotFoundError(f"no file at {path}")
    # the index gives encoded URIs, scans give paths
    names = [re.sub(r"^([A-Za-z][\w+.-]*):///", r"\1:/", unquote(n)) for n in names]
    sizes = source.select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("size"))
    return (spark.createDataFrame([(n,) for n in names], "file string").join(sizes, "file", "left")
            .select("file", F.coalesce("size", F.lit(0)).alias("size")))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of a split put together, with their place in the split."""
    now, at = None, 0
    for batch in slices(batches):
        files, sizes, blocks, runs = (batch.column(k).to_pylist() for k in range(4))
        out, a = [], 0
        for k in range(1, len(files) + 1):
            if k < len(files) and blocks[k] == blocks[a] and files[k] == files[a]:
                continue
            if now != (files[a], blocks[a]):
                now, at = (files[a], blocks[a]), 0
            data = b"\0".join(runs[a:k]) + b"\0"
            out.append((files[a], sizes[a], blocks[a], at, data))
            at += len(data)
            a = k
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                                             names=["file", "size", "block", "at", "data"])


def read_windows(spark: SparkSession, path: str, window: int = WINDOW) -> DataFrame:
    """(file, size, w, data): window ``w`` holds the bytes from ``w * window``
    on, ``window`` of them or up to the end of the file."""
    meta = F.col("_metadata")
    runs = _source(spark, "text", path).select(meta["file_path"].alias("file"), meta["file_size"].alias("size"),
                                               meta["file_block_start"].alias("block"), F.col("value").cast("binary").alias("run"))
    blocks = runs.groupBy("file", "size", "block").agg(F.sum(F.octet_length("run") + 1).alias("n"))
    of_file = Window.partitionBy("file")
    begin = F.coalesce(F.sum("n").over(of_file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # one row a split; a file that is short of its size has lost its mark
    begins = blocks.select("file", "size", "block", begin.alias("_from"), (F.sum("n").over(of_file) < F.col("size")).alias("_marked"))
    shift = F.when(F.col("_marked"), len(BOM)).otherwise(0)
    parts = (runs.mapInArrow(_joined, "file string, size long, block long, at long, data binary")
             .join(begins.drop("size"), ["file", "block"]).select("file", "size", (F.col("_from") + F.col("at") + shift).alias("start"), "data"))
    marks = begins.where("_marked and block = 0").select("file", "size", F.lit(0).cast("long").alias("start"), F.lit(BOM).alias("data"))
    parts = parts.unionAll(marks).withColumn("stop", F.least(F.col("start") + F.octet_length("data"), F.col("size"))).where("stop > start")
    first, last = F.floor(F.col("start") / window), F.floor((F.col("stop") - 1) / window)
    cut = parts.withColumn("w", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
    low = F.greatest(F.col("w") * window, F.col("start"))
    high = F.least((F.col("w") + 1) * window, F.col("stop"))
    piece = F.substring("data", (low - F.col("start") + 1).cast("int"), (high - low).cast("int"))
    # cut before they are gathered: an aggregate that sorts its input would keep the whole part once a window
    cut = cut.select("file", "size", "w", F.struct(low.alias("start"), piece.alias("data")).alias("piece"))
    pieces = F.sort_array(F.collect_list("piece"))  # of one window
    return cut.groupBy("file", "size", "w").agg(F.aggregate(pieces, F.lit(b""), lambda a, p: F.concat(a, p["data"])).alias("data"))


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of streams, in order, as lines that end at zero bytes."""
    rest, now, seq = b"", None, 0

    def batch_of(out):
        text = pa.array([r[2] for r in out], pa.binary()).view(pa.string())  # any bytes
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.int64()), text],
                                          names=["stream", "seq", "value"])

    for batch in slices(batches):
        out = []
        for stream, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if stream != now:
                if rest:
                    out.append((now, seq, rest))
                rest, now, seq = b"", stream, 0
            rest += data
            end = rest.rfind(b"\0")
            if end >= 0:
                out.append((stream, seq, rest[:end]))
                rest, seq = rest[end + 1:], seq + 1
        if out:
            yield batch_of(out)
    if rest:
        yield batch_of([(now, seq, rest)])


def write_streams(pieces: DataFrame, path: str, mode: str = "append") -> None:
    """Write one file per ``stream``, as Spark commits files: those of failed
    attempts are never seen.

    ``pieces``: (stream string, data binary); the rows of a stream lie in one
    partition, in order. Files are ``path/stream=<name>/part-*``. A stream that
    does not end with a zero byte gets one more."""
    lines = pieces.select("stream", "data").mapInArrow(_lines, "stream string, seq long, value string")
    lines.sortWithinPartitions("stream", "seq").select("stream", "value").write.mode(mode).option("lineSep", "\0").partitionBy("stream").text(path)
