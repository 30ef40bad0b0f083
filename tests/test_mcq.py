"""The nested import example and codec round trips."""

import os
import random
import struct

import pytest
from pyspark.sql import functions as F

from colloquy.functions.nested import PathError, expand_template, parse_template, path_values
from colloquy.operators import mcq
from colloquy.session import local_path, scratch_path
from colloquy.sources import mcq as msrc
from colloquy.sources.byte_files import read_windows

SCHEMA = ("document struct<id:string, summary:struct<text:string>, title:string, start:string, text:string>, "
          "question struct<text:string>, answers array<struct<text:string>>")
QF = "{document.title or start} summary: {document.summary.text}\\n\\n{question.text}"
AF = "{answers.text}"


@pytest.fixture(scope="module")
def recs(spark):
    rows = [
        (("0123", ("text summary",), "title", None, "long text"), ("Who does Arabella Mason wed?",),
         [(" Ben Keene, Delmar's valet",), ("Ben Keene ",)]),
        (("1", ("s",), None, "start", "t"), ("q2",), []),
        (("2", ("s",), None, None, "t"), ("q3",), [("x",)]),
    ]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "rid int, " + SCHEMA)


def test_import_example(spark, recs):
    out = {r["rid"]: r for r in mcq.to_mcq(recs, QF, AF, keep=["rid"]).collect()}
    r0 = out[0]
    assert r0["question"] == "title summary: text summary\n\nWho does Arabella Mason wed?"
    assert r0["multiple_correct"]["answers"] == ["Ben Keene, Delmar's valet", "Ben Keene"]
    assert r0["multiple_correct"]["labels"] == [1, 1]
    assert r0["single_correct"]["answers"] == [] and r0["single_correct"]["labels"] == []
    # alternative: title missing (NULL) -> start; no answers -> empty arrays
    assert out[1]["question"].startswith("start summary:")
    assert out[1]["multiple_correct"]["answers"] == []
    # both alternatives NULL: the question yields nothing and the record is skipped
    assert 2 not in out


def test_cross_product_and_paths(spark, recs):
    two = expand_template(recs.schema, "{answers.text}|{answers.text}")
    got = recs.where("rid = 0").select(two).collect()[0][0]
    assert len(got) == 4 and got[1] == " Ben Keene, Delmar's valet|Ben Keene "
    vals = recs.select("rid", path_values(recs.schema, "answers.text").alias("v")).orderBy("rid").collect()
    assert [len(r["v"]) for r in vals] == [2, 0, 1]
    with pytest.raises(PathError):
        path_values(recs.schema, "document.missing")
    with pytest.raises(PathError):
        path_values(recs.schema, "question.text.deeper")
    assert parse_template("a{x}b{ y }c") == (["a", "b", "c"], ["x", "y"])


def test_explode_and_validate(spark, recs):
    m = mcq.to_mcq(recs, QF, AF, keep=["rid"])
    e = mcq.explode_mcq(m, keep=["rid"]).collect()
    assert sorted((r["rid"], r["idx"], r["label"]) for r in e) == [(0, 0, 1), (0, 1, 1)]
    bad = spark.createDataFrame([("q", (["a"], [1]), (["a", "b"], [1]))],
                                "question string, single_correct struct<answers:array<string>, labels:array<int>>, "
                                "multiple_correct struct<answers:array<string>, labels:array<int>>")
    good, rejects = mcq.split_valid(bad)
    assert good.count() == 0 and rejects.count() == 1


MCQ = ("question string, single_correct struct<answers:array<string>, labels:array<int>>, "
       "multiple_correct struct<answers:array<string>, labels:array<int>>")


def records(n, seed=1):
    rng = random.Random(seed)
    text = lambda: "".join(rng.choices("ab é中\n\0\x80𝒳", k=rng.randrange(0, 30)))
    out = []
    for k in range(n):
        blocks = []
        for _ in range(2):
            size = rng.randrange(4)
            blocks.append(([text() for _ in range(size)], [rng.choice([0, 1, -1, -(1 << 31), (1 << 31) - 1]) for _ in range(size)]))
        out.append((f"{k}:{text()}", *blocks))
    return out


def plain_file(rows):
    """The layout, written down once more."""
    s = lambda t: struct.pack("<I", len(t.encode())) + t.encode()
    block = lambda b: struct.pack("<I", len(b[0])) + b"".join(map(s, b[0])) + struct.pack(f"<{len(b[1])}i", *b[1])
    body = [s(q) + block(x) + block(y) for q, x, y in rows]
    starts, at = [], 4 + 4 * len(body)
    for r in body:
        starts.append(at)
        at += len(r)
    return struct.pack(f"<I{len(body)}I", len(body), *starts) + b"".join(body)


def put(folder, **files):
    os.makedirs(folder, exist_ok=True)
    for name, data in files.items():
        with open(os.path.join(folder, name + ".bin"), "wb") as f:
            f.write(data)


def got(df):
    return sorted((r.question, tuple(map(tuple, r.single_correct)), tuple(map(tuple, r.multiple_correct))) for r in df.collect())


def want(rows):
    return sorted((q, tuple(map(tuple, a)), tuple(map(tuple, b))) for q, a, b in rows)


def written(path):
    return [os.path.join(d, f) for d, _, fs in os.walk(local_path(path)) for f in fs if f.startswith("part-") and f.endswith(".txt")]


def test_bin_files_have_the_layout(spark):
    rows = records(300)
    path = scratch_path(spark, "test-bin")
    msrc.write_mcq_bin(spark.createDataFrame(rows, MCQ).coalesce(1), path)
    (name,) = written(path)
    raw, plain = open(name, "rb").read(), plain_file(rows)
    assert raw == plain + b"\0" * (not plain.endswith(b"\0"))  # a stream ends with a zero byte
    assert got(msrc.read_mcq_bin(spark, path)) == want(rows)


def test_bin_writer_closes_files(spark):
    rows = records(300, 2)
    df = spark.createDataFrame(rows, MCQ).repartition(3)
    for options in ({"shard_records": 7}, {"shard_bytes": 700}):
        path = scratch_path(spark, "test-bin")
        msrc.write_mcq_bin(df, path, **options)
        files = written(path)
        assert len(files) > 40
        assert all(struct.unpack_from("<I", open(f, "rb").read())[0] <= 7 for f in files) or "shard_bytes" in options
        assert "shard_records" in options or max(map(os.path.getsize, files)) <= 1000
        assert got(msrc.read_mcq_bin(spark, path)) == want(rows)
    msrc.write_mcq_bin(df, path)  # appends
    assert msrc.read_mcq_bin(spark, path).count() == 600
    msrc.write_mcq_bin(df.limit(5), path, mode="overwrite")
    assert msrc.read_mcq_bin(spark, path).count() == 5


def test_bin_writer_leaves_nothing_of_a_failed_job(spark):
    path = scratch_path(spark, "test-bin")
    bad = spark.createDataFrame(records(50) + [("q", (["a"], []), ([], []))], MCQ).repartition(2)
    with pytest.raises(Exception, match="1 answers do not go with 0 labels"):
        msrc.write_mcq_bin(bad, path)
    assert not written(path)


@pytest.fixture(scope="module")
def damaged(spark):
    """A folder of sound and damaged files; (folder, rows of the sound ones, rejects)."""
    rows = {k: records(40, seed) for seed, k in enumerate(("one", "two", "cut", "text", "swap", "tail", "huge"))}
    rows["huge"][3] = ("long " * 5000, ([], []), ([], []))
    raw = {k: plain_file(r) for k, r in rows.items()}
    files = {"one": raw["one"], "two": raw["two"], "huge": raw["huge"], "tail": raw["tail"] + b"more bytes\0\n"}
    files["cut"] = raw["cut"][:-3]
    files["header"] = raw["cut"][:60]
    files["short"] = b"\1\0"
    files["empty"] = b""
    files["none"] = struct.pack("<I", 0)
    at = struct.unpack_from("<I", raw["text"], 4 + 4 * 7)[0]
    files["text"] = raw["text"][:at + 4] + b"\xff" + raw["text"][at + 5:]
    swapped = bytearray(raw["swap"])
    swapped[12:20] = swapped[16:20] + swapped[12:16]
    files["swap"] = bytes(swapped)
    files["far"] = raw["one"][:8] + struct.pack("<I", 10**9) + raw["one"][12:]
    folder = local_path(scratch_path(spark, "test-cut"))
    put(folder, **files)
    sound = [r for k in ("one", "two", "huge", "tail") for r in rows[k]]
    rejects = {"cut": ("truncated", 40, 39), "header": ("header", 40, None), "short": ("header", None, None), "empty": ("header", None, None),
               "text": ("text", 40, 7), "swap": ("offsets", 40, None), "far": ("offsets", 40, None)}
    return folder, sound, rejects


@pytest.mark.parametrize("window", [16, 64, 100, 4096, 1 << 22])
def test_bin_reader_is_the_same_for_every_window(spark, damaged, window):
    folder, sound, rejects = damaged
    good, bad = msrc.scan_mcq_bin(spark, folder, window=window)
    assert got(good) == want(sound)
    assert {os.path.basename(r.file)[:-4]: (r.reason, r.n_records, r.first_bad) for r in bad.collect()} == rejects


def test_bin_reader_splits_files(spark, damaged):
    """Small input splits, and one that is not the begin of its file."""
    folder, sound, _ = damaged
    spark.conf.set("spark.sql.files.maxPartitionBytes", "777")
    try:
        assert got(msrc.scan_mcq_bin(spark, folder, window=256)[0]) == want(sound)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_bin_reader_on_another_file_system(spark, damaged):
    folder, sound, _ = damaged
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = local_path(scratch_path(spark, "test-view"))
    os.makedirs(out)
    conf.set("fs.viewfs.mounttable.bins.link./data", "file://" + folder)
    conf.set("fs.viewfs.mounttable.bins.link./out", "file://" + out)
    assert got(msrc.read_mcq_bin(spark, "viewfs://bins/data")) == want(sound)
    msrc.write_mcq_bin(spark.createDataFrame(sound, MCQ), "viewfs://bins/out/set")
    assert got(msrc.read_mcq_bin(spark, "viewfs://bins/out/set")) == want(sound)


def test_bin_reader_raises(spark, damaged):
    folder = damaged[0]
    with pytest.raises(msrc.TruncatedRecord):
        msrc.read_mcq_bin(spark, folder, mode="FAILFAST")
    empty = local_path(scratch_path(spark, "test-none"))
    os.makedirs(empty)
    with pytest.raises(FileNotFoundError):
        msrc.read_mcq_bin(spark, empty)
    with pytest.raises(ValueError):
        msrc.read_mcq_bin(spark, folder, window=6)


def test_windows_give_every_byte(spark):
    """Also of a file that begins with a byte order mark, as a count may."""
    rng = random.Random(6)
    files = {"mark": b"\xef\xbb\xbf\0" + rng.randbytes(500), "zeros": b"\0" * 100, "one": b"x", "lines": b"a\nb\r\nc" * 50, "end": b"ab\0"}
    folder = local_path(scratch_path(spark, "test-bytes"))
    put(folder, **files)
    parts = sorted((os.path.basename(r.file)[:-4], r.w, bytes(r.data)) for r in read_windows(spark, folder, 64).collect())
    assert {k: b"".join(d for f, _, d in parts if f == k) for k in files} == files
    assert all(len(d) == 64 or w == (len(files[f]) - 1) // 64 for f, w, d in parts)


def test_empty_set_writes_count_only(spark):
    path = scratch_path(spark, "test-none")
    msrc.write_mcq_bin(spark.createDataFrame(spark.sparkContext.parallelize([], 1), MCQ), path)
    assert [open(f, "rb").read() for f in written(path)] == [struct.pack("<I", 0)]
    assert msrc.read_mcq_bin(spark, path).count() == 0
    with pytest.raises(ValueError):
        msrc.encode_record("q", (["a"], []), None)


def test_json_defaults(spark):
    path = scratch_path(spark, "test-json")
    os.makedirs(local_path(path), exist_ok=True)
    with open(os.path.join(local_path(path), "x.json"), "w") as f:
        f.write('{"question": "q1", "multiple_correct": {"answers": ["a"], "labels": [1]}}\n{"single_correct": {}}\n')
    rows = msrc.read_mcq_json(spark, path).collect()
    assert rows[0]["single_correct"]["answers"] == [] and rows[0]["multiple_correct"]["labels"] == [1]
    assert rows[1]["question"] == "" and rows[1]["multiple_correct"]["answers"] == []
    out = scratch_path(spark, "test-json-out")
    msrc.write_mcq_json(msrc.read_mcq_json(spark, path), out)
    assert msrc.read_mcq_json(spark, out).count() == 2


def test_windows_are_cut_before_they_are_gathered(spark):
    path = scratch_path(spark, "test-cut")
    msrc.write_mcq_bin(spark.createDataFrame([("q" * 3000, None, None)], "question string, single_correct struct<answers:array<string>,labels:array<int>>, "
                                             "multiple_correct struct<answers:array<string>,labels:array<int>>"), path)
    plan = read_windows(spark, path, 512)._jdf.queryExecution().optimizedPlan().toString()
    gathered = [line for line in plan.splitlines() if "collect_list(" in line]
    assert gathered and not any("substring(" in line for line in gathered)  # no whole part in an aggregate's input


def test_python_functions_work_in_slices():
    import pyarrow as pa

    blobs = [bytes([65 + k % 26]) * 10_000 for k in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(["s"] * 1001), pa.array([0] + [2] * 1000, pa.int32()), pa.array(range(1001), pa.int64()),
                                        pa.array([struct.pack("<I", 1000), *blobs], pa.binary())], names=["stream", "kind", "seq", "data"])
    out = list(msrc._with_tables(iter([batch])))
    assert [d for b in out for d in b.column(1).to_pylist()][1:] == blobs
    assert max(b.nbytes for b in out) < 3 << 20  # 10 MB at once before

    record = msrc.encode_record("q", None, None)
    rows = pa.RecordBatch.from_pylist([{"file": f"f{k}", "size": 8 + len(record), "w": 0, "data": struct.pack("<II", 1, 8) + record,
                                        "i": [0], "starts": [8], "following": 8 + len(record)} for k in range(300)])
    out = list(msrc._of_windows(512)(iter([rows])))
    assert len(out) == 1 and out[0].column("question").to_pylist() == ["q"] * 300  # a frame for each window before
    assert out[0].column("fault").null_count == 300
