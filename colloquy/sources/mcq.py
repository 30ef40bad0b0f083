"""Multiple-choice files, binary and JSON.

Binary layout (little-endian): ``uint32 n``; ``n x uint32`` absolute record
offsets; per record: question string, single block, multiple block;
string = ``uint32`` byte length + UTF-8 bytes; block = ``uint32 k``, ``k``
strings, ``k x int32`` labels. Offsets are 32-bit, so one file stays
below 4 GiB.

Reading: the bytes come in windows (``byte_files``); the offset table, itself
read window by window, deals every record to the window it starts in; a record
that runs over the end of its window is put together from the windows it
touches. So a file is read by as many tasks as it has splits and windows, and
what is returned does not depend on their size. A file counts as a whole: if
its header, an offset or a record is damaged, it gives no rows but a line in
the frame of rejects.

Writing: every task streams its records, rolls to a new file before the
offsets can overflow, and puts the offset table, known at the end, in front
by a sort inside the partition.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from colloquy.schemas import MCQ
from colloquy.session import scratch_path
from colloquy.sources.byte_files import SLICE, WINDOW, list_files, read_windows, slices, write_streams

_U32 = struct.Struct("<I")
SHARD_BYTES = 128 << 20   # a file is closed before it grows beyond this
SHARD_RECORDS = 1 << 20
LIMIT = 1 << 32
TABLE_RUN = 4096          # offsets written at once


class TruncatedRecord(ValueError):
    pass


# ----------------------------------------------------------------- codec
def _enc_str(s: str | None) -> bytes:
    b = (s or "").encode("utf-8")
    return _U32.pack(len(b)) + b


def _block_fields(block) -> tuple[list, list]:
    if block is None:
        return [], []
    if isinstance(block, dict):
        return list(block.get("answers") or []), list(block.get("labels") or [])
    return list(block[0] or []), list(block[1] or [])


def _enc_block(block) -> bytes:
    answers, labels = _block_fields(block)
    if len(answers) != len(labels):
        raise ValueError(f"{len(answers)} answers do not go with {len(labels)} labels")
    out = [_U32.pack(len(answers))] + [_enc_str(a) for a in answers]
    out.append(struct.pack(f"<{len(labels)}i", *[int(x) for x in labels]))
    return b"".join(out)


def encode_record(question, single, multiple) -> bytes:
    return _enc_str(question) + _enc_block(single) + _enc_block(multiple)


def _dec_str(buf, pos):
    if pos + 4 > len(buf):
        raise TruncatedRecord(pos)
    (n,) = _U32.unpack_from(buf, pos)
    pos += 4
    if pos + n > len(buf):
        raise TruncatedRecord(pos)
    return bytes(buf[pos:pos + n]).decode("utf-8"), pos + n


def _dec_block(buf, pos):
    if pos + 4 > len(buf):
        raise TruncatedRecord(pos)
    (k,) = struct.unpack_from("<i", buf, pos)
    if k < 0:
        raise TruncatedRecord(pos)
    pos += 4
    answers = []
    for _ in range(k):
        a, pos = _dec_str(buf, pos)
        answers.append(a)
    if pos + 4 * k > len(buf):
        raise TruncatedRecord(pos)
    labels = list(struct.unpack_from(f"<{k}i", buf, pos))
    return (answers, labels), pos + 4 * k


def decode_record(buf, pos: int):
    """((question, single, multiple), place behind the record)."""
    q, pos = _dec_str(buf, pos)
    single, pos = _dec_block(buf, pos)
    multiple, pos = _dec_block(buf, pos)
    return (q, single, multiple), pos


# ----------------------------------------------------------------- reader
_BLOCK = "struct<answers:array<string>,labels:array<int>>"
_DECODED = f"file string, i long, start long, stop long, until long, fault string, question string, single_correct {_BLOCK}, multiple_correct {_BLOCK}"


_ARROW = pa.schema([("file", pa.string()), ("i", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("until", pa.int64()),
                    ("fault", pa.string()), ("question", pa.string())]
                   + [(c, pa.struct([("answers", pa.list_(pa.string())), ("labels", pa.list_(pa.int32()))])) for c in ("single_correct", "multiple_correct")])
OUT_ROWS = 4096  # rows returned at once, fewer if they are long


def _rows(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*out), _ARROW)], schema=_ARROW)


def _gathered(rows: Iterator[tuple[int, tuple]]) -> Iterator[pa.RecordBatch]:
    """(bytes, row) as batches of many rows, for windows may hold one or none."""
    out, held = [], 0
    for n, row in rows:
        out.append(row)
        held += n
        if held >= SLICE or len(out) >= OUT_ROWS:
            yield _rows(out)
            out, held = [], 0
    if out:
        yield _rows(out)


def _decoded(buf, at: int, base: int, until: int, file: str, i: int) -> tuple:
    """One row of a record that starts at ``at`` of ``buf``, which ends where
    the next record of the table starts."""
    try:
        (q, single, multiple), end = decode_record(buf, at)
        block = lambda b: {"answers": b[0], "labels": b[1]}
        return file, i, base + at, base + end, until, None, q, block(single), block(multiple)
    except TruncatedRecord:
        return file, i, base + at, None, until, "truncated", None, None, None
    except UnicodeDecodeError:
        return file, i, base + at, None, until, "text", None, None, None


def _offsets(window: int):
    """Entries of the offset table, dealt to the windows they point into."""
    kinds = (pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))

    def frame(out):
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out), kinds)], names=["file", "w", "i", "starts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for batch in slices(batches):
            for file, n, w, data in zip(*(batch.column(c).to_pylist() for c in ("file", "n", "w", "data"))):
                base = w * window
                a, b = max(4, base), min(4 + 4 * n, base + len(data))
                starts = np.frombuffer(data, "<u4", (b - a) // 4, a - base).astype(np.int64)
                i = np.arange(len(starts)) + (a - 4) // 4
                home = starts // window
                order = np.lexsort((i, home))
                cuts = np.flatnonzero(np.r_[True, np.diff(home[order]) != 0]) if len(order) else []
                out += [(file, int(home[o[0]]), i[o], starts[o]) for o in np.split(order, cuts[1:]) if len(o)]
                held += 16 * len(order)
                if held >= SLICE or len(out) >= OUT_ROWS:
                    yield from [frame(out)] * bool(out)
                    out, held = [], 0
        if out:
            yield frame(out)
    return run


def _of_windows(window: int):
    """Records of each window. One that needs bytes behind the window comes
    back without content, as ``open``."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, tuple]]:
        for batch in batches:
            for at in range(batch.num_rows):  # one window at a time becomes an object
                file, size, w, data, following = (batch.column(c)[at].as_py() for c in ("file", "size", "w", "data", "following"))
                i, starts = (batch.column(c)[at].values.to_numpy(zero_copy_only=False) for c in ("i", "starts"))
                order = np.lexsort((i, starts))
                i, starts = i[order], starts[order]
                until = np.r_[starts[1:], following]
                base, whole = w * window, w * window + len(data) >= size
                for k, s, u in zip(i.tolist(), starts.tolist(), np.minimum(until, size).tolist()):
                    row = _decoded(memoryview(data)[:max(0, u - base)], s - base, base, u, file, k)
                    if row[5] == "truncated" and not whole and u > base + len(data):
                        row = (*row[:5], "open", *row[6:])
                    yield max(0, u - s), row

    return lambda batches: _gathered(rows(batches))


def _of_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in slices(batches):
            for file, i, start, until, data in zip(*(batch.column(c).to_pylist() for c in ("file", "i", "start", "until", "data"))):
                yield len(data), _decoded(memoryview(data), 0, start, until, file, i)

    return _gathered(rows())


def _u32(data: Column) -> Column:
    """The first four bytes as a little-endian number."""
    h = F.hex(F.substring(data, 1, 4))
    return F.conv(F.concat(*[F.substring(h, k, 2) for k in (7, 5, 3, 1)]), 16, 10).cast("long")


def scan_mcq_bin(spark: SparkSession, path: str, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of the binary files at ``path``.

    Records: file, i (place in the file) and the multiple-choice columns.
    Rejects: file, reason (``header``: the offset table does not fit;
    ``truncated``, ``text``: a record runs over its end or is not UTF-8;
    ``offsets``: the table does not follow the records), n_records (as the
    header says, null without one), first_bad (null for a whole-file reason).
    Bytes behind the last record are ignored. Raises if there is no file."""
    if window < 4 or window % 4:
        raise ValueError("a window holds a positive multiple of four bytes")
    files = list_files(spark, path)
    scratch = scratch_path(spark, "mcq-scan")
    read_windows(spark, path, window).write.option("compression", "zstd").parquet(f"{scratch}/windows")
    windows = spark.read.schema("file string, size long, w long, data binary").parquet(f"{scratch}/windows")
    counted = windows.where("w = 0 and octet_length(data) >= 4").select("file", _u32(F.col("data")).alias("n"))
    heads = files.join(counted, "file", "left").withColumn("sound", F.coalesce(4 + 4 * F.col("n") <= F.col("size"), F.lit(False)))
    table = (windows.join(heads.where("sound and n > 0").select("file", "n"), "file").where(F.col("w") * window < 4 + 4 * F.col("n"))
             .select("file", "n", "w", "data").mapInArrow(_offsets(window), "file string, w long, i array<long>, starts array<long>"))
    dealt = (table.groupBy("file", "w").agg(F.flatten(F.collect_list("i")).alias("i"), F.flatten(F.collect_list("starts")).alias("starts"))
             .withColumn("low", F.array_min("starts")))  # of one window
    following = F.lead("low").over(Window.partitionBy("file").orderBy("w"))  # one row a window
    dealt = dealt.withColumn("following", following).drop("low")
    met = windows.join(dealt, ["file", "w"]).withColumn("following", F.coalesce("following", "size"))
    direct = met.select("file", "size", "w", "data", "i", "starts", "following").mapInArrow(_of_windows(window), _DECODED)
    direct.write.parquet(f"{scratch}/direct")
    direct = spark.read.schema(_DECODED).parquet(f"{scratch}/direct")
    spans = (direct.where("fault = 'open'").select("file", "i", "start", "until")
             .withColumn("w", F.explode(F.sequence(F.floor(F.col("start") / window), F.floor((F.col("until") - 1) / window)))))
    low = F.greatest(F.col("start") - F.col("w") * window, F.lit(0))
    high = F.least(F.col("until") - F.col("w") * window, F.lit(window))
    pieces = F.sort_array(F.collect_list(F.struct("w", F.substring("data", (low + 1).cast("int"), (high - low).cast("int")).alias("data"))))
    parts = (spans.join(windows.select("file", "w", "data"), ["file", "w"]).groupBy("file", "i", "start", "until")
             .agg(F.aggregate(pieces, F.lit(b""), lambda a, p: F.concat(a, p["data"])).alias("data")))  # one record
    parts.mapInArrow(_of_parts, _DECODED).write.parquet(f"{scratch}/parts")  # read twice, as the direct ones
    decoded = direct.where("fault is null or fault <> 'open'").unionAll(spark.read.schema(_DECODED).parquet(f"{scratch}/parts"))

    # the ends of the records are the starts of the next ones, the first follows the table
    mark = lambda place, i: F.xxhash64(place, i).cast("decimal(38,0)")
    seen = decoded.groupBy("file").agg(
        F.count(F.lit(1)).alias("seen"), F.min(F.when(F.col("fault").isNotNull(), F.struct("i", "fault"))).alias("bad"),
        F.sum(mark(F.col("start"), F.col("i"))).alias("starts"), F.sum(mark(F.col("stop"), F.col("i") + 1)).alias("stops"),
        F.max(F.struct("i", "stop")).alias("last"))
    first, end = mark(4 + 4 * F.col("n"), F.lit(0).cast("long")), mark(F.col("last.stop"), F.col("n"))
    chained = (F.col("starts") - first == F.col("stops") - end) & (F.col("seen") == F.col("n"))
    reason = (F.when(~F.col("sound"), "header").when(F.col("n") == 0, F.lit(None)).when(F.col("bad").isNotNull(), F.col("bad.fault"))
              .when(~F.coalesce(chained, F.lit(False)), "offsets"))
    told = heads.join(seen, "file", "left").select("file", reason.alias("reason"), F.col("n").alias("n_records"), F.col("bad.i").alias("first_bad"))
    told.write.parquet(f"{scratch}/files")
    rejects = spark.read.schema("file string, reason string, n_records long, first_bad long").parquet(f"{scratch}/files").where("reason is not null")
    records = decoded.join(rejects.select("file"), "file", "left_anti").select("file", "i", "question", "single_correct", "multiple_correct")
    return records, rejects


def read_mcq_bin(spark: SparkSession, path: str, window: int = WINDOW, mode: str = "PERMISSIVE") -> DataFrame:
    """The records of all undamaged files; ``FAILFAST`` raises on a damaged one."""
    records, rejects = scan_mcq_bin(spark, path, window)
    if mode.upper() == "FAILFAST":
        bad = rejects.first()
        if bad:
            raise TruncatedRecord(f"{bad.file}: {bad.reason}")
    return records.select("question", "single_correct", "multiple_correct")


# ----------------------------------------------------------------- writer
def _sharded(shard_bytes: int, shard_records: int, named: bool):
    """Encoded records with their file (number in the task) and place; of
    each file a row with its number of records (kind 0) and rows with the
    lengths of its records (kind 1), which sort before the records. With
    ``named``, a file's name is that of its set, and sets come in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        shard, n, size, lengths, out, held, own = 0, 0, 4, [], [], 0, None

        def frame():
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out), kinds)], names=["stream", "kind", "seq", "data"])

        def name():
            return own if named else f"{task:05d}-{shard:05d}"

        def table():
            out.append((name(), 1, n - len(lengths), struct.pack(f"<{len(lengths)}I", *lengths)))
            lengths.clear()

        for batch in slices(batches):
            for r in batch.to_pylist():
                data = encode_record(r["question"], r["single_correct"], r["multiple_correct"])
                full = size + len(data) + 4 > shard_bytes or n >= shard_records
                if n and (r["_set"] != own if named else full):
                    table()
                    out.append((name(), 0, 0, struct.pack("<I", n)))
                    shard, n, size = shard + 1, 0, 4
                own = r["_set"] if named else None
                if len(data) + 8 >= LIMIT:
                    raise ValueError("a record exceeds the 32-bit offset range")
                out.append((name(), 2, n, data))
                n, size, held = n + 1, size + len(data) + 4, held + len(data)
                lengths.append(len(data))
                if len(lengths) == TABLE_RUN:
                    table()
                if held >= SLICE:
                    yield frame()
                    out, held = [], 0
        if n or (task == 0 and not shard and not named):  # an empty table still is a file, of a count
            if lengths:
                table()
            out.append((name(), 0, 0, struct.pack("<I", n)))
        if out:
            yield frame()
    return run


def _with_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count, offsets, records, in the order they came sorted in."""
    at = 0
    for batch in slices(batches):
        out = []
        for stream, kind, data in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3))):
            if kind == 0:
                at = 4 + 4 * _U32.unpack(data)[0]
            elif kind == 1:
                lengths = np.frombuffer(data, "<u4").astype(np.int64)
                starts = at + np.cumsum(lengths) - lengths
                at += int(lengths.sum())
                if at >= LIMIT:
                    raise ValueError("a file exceeds the 32-bit offset range")
                data = starts.astype("<u4").tobytes()
            out.append((stream, data))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), (pa.string(), pa.binary()))], names=["stream", "data"])


def write_mcq_bin(df: DataFrame, path: str, mode: str = "append", shard_bytes: int = SHARD_BYTES, shard_records: int = SHARD_RECORDS) -> None:
    """Self-contained files ``path/stream=<task>-<number>/part-*``, each
    closed before ``shard_bytes`` or ``shard_records``; committed by Spark, so
    a failed attempt leaves nothing behind."""
    rows = df.select("question", "single_correct", "multiple_correct")
    shards = rows.mapInArrow(_sharded(shard_bytes, shard_records, False), "stream string, kind int, seq long, data binary")
    ordered = shards.sortWithinPartitions("stream", "kind", "seq")
    write_streams(ordered.mapInArrow(_with_tables, "stream string, data binary"), path, mode)


def write_mcq_bin_sets(df: DataFrame, name: str, path: str, mode: str = "append") -> None:
    """S8, one file per value of the string column ``name``:
    ``path/stream=<value>/part-*``. The rows of a value lie together in one
    partition; a set that exceeds the 32-bit offsets raises."""
    rows = df.select("question", "single_correct", "multiple_correct", F.col(name).alias("_set"))
    shards = rows.mapInArrow(_sharded(LIMIT, LIMIT, True), "stream string, kind int, seq long, data binary")
    ordered = shards.sortWithinPartitions("stream", "kind", "seq")
    write_streams(ordered.mapInArrow(_with_tables, "stream string, data binary"), path, mode)


# ----------------------------------------------------------------- JSON
def read_mcq_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Missing keys default to ``""`` / ``[]``."""
    df = spark.read.schema(MCQ).option("multiLine", multi_line).json(path)

    def block(c):
        return F.struct(F.coalesce(F.col(f"{c}.answers"), F.array().cast("array<string>")).alias("answers"),
                        F.coalesce(F.col(f"{c}.labels"), F.array().cast("array<int>")).alias("labels"))

    return df.select(F.coalesce("question", F.lit("")).alias("question"),
                     block("single_correct").alias("single_correct"),
                     block("multiple_correct").alias("multiple_correct"))


def write_mcq_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Question / answers / labels objects as JSON lines."""
    df.select("question", "single_correct", "multiple_correct").write.mode(mode).json(path)
