"""Packing documents into fixed sequences: concatenate and cut (operator 8).

Pass one encodes every text once, appends the end id, and writes the ids with
their offset inside the writing partition. The partitions' totals, one row
each, become global offsets by a prefix sum. Pass two cuts the one long line
of ids at every multiple of the window; the pieces carry boundary records, so
a sequence can be put together from its pieces alone. Only the last sequence
is padded.

Defined results: a null or empty text is the end id alone; repeated rows are
packed like any others; an empty table gives no pieces. Other columns are
ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colloquy.llm.common import stored

VOCABULARY = "word_bpe_49k.json"
WINDOW = 4096
END_ID = 2
MEMO = 800_000
SLICE_BYTES = 4 << 20  # of texts encoded at once
# how the vocabulary's tokenizer cuts units; the same for ASCII and the letters of Latin-1
_UNITS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_UNIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\[-`{-~]+")
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # of ASCII, without the apostrophe


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(own)))}


class _Ids(dict):
    """Chunk of a text (no ASCII white space) -> its ids as little-endian uint32.

    The tokenizer drops white space before it looks at anything else and never
    merges across it, so a text's ids are those of its chunks in order. A chunk
    of ASCII and Latin-1 letters is cut into units here, and new units go to
    the tokenizer's model; any other chunk goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a task per core
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.units, self.letters = Tokenizer(self.tokenizer.model), _byte_letters()
        self.units.pre_tokenizer = WhitespaceSplit()
        spec = json.loads(self.tokenizer.to_str())
        steps = [(spec[k] or {}).get(f"{k}s" if k == "normalizer" else "pretokenizers", []) for k in ("normalizer", "pre_tokenizer")]
        self.cuts_units = ([x["type"] for x in steps[0]] == ["NFC", "Replace", "Lowercase"]
                           and [x["type"] for x in steps[1]] == ["Split", "ByteLevel"]
                           and steps[1][0]["pattern"] == {"Regex": _UNITS} and not steps[1][1]["add_prefix_space"]
                           and spec["post_processor"] is None and bool(end := spec["model"].get("end_of_word_suffix")))
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends_unit = np.zeros(max(vocabulary.values(), default=0) + 2, bool)
        self.ends_unit[[i for token, i in vocabulary.items() if end and token.endswith(end)]] = True

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, memoryview]:
        """Bytes of ids: where each text begins and the last ends, and all of
        them. Each distinct chunk is looked up once."""
        # marks of special tokens are case-sensitive; all else is lower-cased anyway
        texts = pc.fill_null(texts, "")
        texts = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        split = pc.ascii_split_whitespace(texts)
        chunks = split.flatten().dictionary_encode()
        names = _values(chunks.dictionary)
        new = [c for c in names if c not in self]
        if len(self) + 2 * len(new) > MEMO:
            self.clear()
            new = names
        self.learn(new)
        blobs = [self[c] for c in names]
        ends = np.cumsum(np.fromiter(map(len, blobs), np.int64, len(blobs)))
        ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(blobs), [None, pa.py_buffer(np.r_[np.int64(0), ends]), pa.py_buffer(b"".join(blobs))])
        _, offsets, values = ids.take(chunks.indices).buffers()
        at = np.frombuffer(offsets, np.int64) if offsets else np.zeros(1, np.int64)
        first = split.offsets.to_numpy()
        return at[first - first[0]], memoryview(values or b"")

    def learn(self, new: list[bytes]) -> None:
        """Cuts chunks into units, has the model encode the new ones, many to a
        call, and puts the chunks together."""
        hard, units, tailed, cut = [], set(), [], {}
        for chunk in new:
            if not self.cuts_units:
                hard.append(chunk)
            elif chunk.isalpha() and chunk.islower():  # letters of ASCII
                units.add(chunk)
            elif (head := chunk.rstrip(_MARKS)).isalpha() and head.islower():
                tailed.append((chunk, head, chunk[len(head):]))
            elif b"<|" not in chunk and _PLAIN.fullmatch(text := chunk.decode("utf-8", "replace")):
                cut[chunk] = [u.encode() for u in _UNIT.findall(text.lower())]
            else:
                hard.append(chunk)
        units.update([t[1] for t in tailed], [t[2] for t in tailed], *cut.values())
        units = [u for u in units if u not in self]
        for s in range(0, len(units), 8192):
            hard += self.learn_units(units[s:s + 8192])
        for s in range(0, len(hard), 4096):
            part = hard[s:s + 4096]
            texts = [c.decode("utf-8", "replace") for c in part]
            for chunk, e in zip(part, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                self[chunk] = np.array(e.ids, "<u4").tobytes()
        for chunk, head, tail in tailed:
            self[chunk] = self[head] + self[tail]
        for chunk, u in cut.items():
            self[chunk] = b"".join([self[x] for x in u])

    def learn_units(self, units: list[bytes]) -> list[bytes]:
        """The last id of a unit carries the end of a word, so units are
        encoded many to a call and split at those ids. Returns the units of
        calls that do not split evenly."""
        failed = []
        names = [u.decode("latin-1") if u.isascii() else u.decode("latin-1").translate(self.letters) for u in units]
        groups = range(0, len(units), 128)
        encoded = self.units.encode_batch_fast([" ".join(names[s:s + 128]) for s in groups], add_special_tokens=False)
        for s, e in zip(groups, encoded):
            ids, group = np.array(e.ids, "<u4"), units[s:s + 128]
            ends = np.flatnonzero(self.ends_unit[ids]) + 1
            if len(ends) != len(group):
                failed += group
                continue
            raw, at = ids.tobytes(), 0
            for unit, end in zip(group, (4 * ends).tolist()):
                self[unit] = raw[at:end]
                at = end
        return failed


def _values(strings: pa.Array) -> list[bytes]:
    """The values of a string array without nulls."""
    _, offsets, data = strings.buffers()
    at = np.frombuffer(offsets, np.int32, len(strings) + 1, 4 * strings.offset).tolist() if len(strings) else [0]
    raw = bytes(memoryview(data)[:at[-1]]) if data else b""
    return [raw[a:b] for a, b in zip(at, at[1:])]


@lru_cache(maxsize=1)
def _ids(path: str) -> _Ids:
    """Built once per worker process."""
    return _Ids(path)


def _by_bytes(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about ``SLICE_BYTES`` of text, of one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    ends = np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES, append=-1)) + 1
    for start, end in zip([0, *ends.tolist()], ends.tolist()):
        yield batch.slice(start, end - start)


def _encode(path: str, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, offset, ids = TaskContext.get().partitionId(), 0, _ids(path)
        for batch in batches:
            for some in _by_bytes(batch):
                at, values = ids.encode(some.column("text"))
                at = at.tolist()
                blobs = [bytes(values[a:b]) + end for a, b in zip(at, at[1:])]
                n = np.array([len(b) // 4 for b in blobs], np.int64)
                begin = offset + np.cumsum(n) - n
                offset += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part, np.int32)), pa.array(begin), pa.array(n), some.column("doc_id"),
                     pa.array(blobs, pa.binary())], names=["part", "begin", "n", "doc_id", "ids"])
    return run


def encoded(docs: DataFrame, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Pass one, written once: part, begin (offset in the part), n, doc_id, ids."""
    import public_tokenizers

    at = path or public_tokenizers.path(VOCABULARY)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(rows.mapInArrow(_encode(at, end_id), "part int, begin long, n long, doc_id long, ids binary"), "packing-ids")


def _cut(window: int, with_ids: bool):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 64):
                some = batch.slice(s, 64)
                at = some.column("at").to_numpy(zero_copy_only=False)
                n = some.column("n").to_numpy(zero_copy_only=False)
                pieces = ((at + n - 1) // window - at // window + 1).astype(np.int64)
                row = np.repeat(np.arange(len(n)), pieces)
                seq = at[row] // window + np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                low, high = np.maximum(at[row], seq * window), np.minimum(at[row] + n[row], (seq + 1) * window)
                start, length = low - at[row], high - low
                blobs = [memoryview(b) for b in some.column("ids").to_pylist()]
                cut = [blobs[r][4 * a:4 * (a + k)] for r, a, k in zip(row.tolist(), start.tolist(), length.tolist())]
                crc = np.array([zlib.crc32(c) for c in cut], np.int64)
                columns = [some.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(length), pa.array(crc),
                           pa.array(n[row]), pa.array(seq), pa.array(low - seq * window)]
                yield pa.RecordBatch.from_arrays(columns + [pa.array([bytes(c) for c in cut], pa.binary())] * with_ids, names=names)
    return run


def pack(docs: DataFrame, window: int = WINDOW, path: str | None = None, end_id: int = END_ID,
         with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset and, if wanted, the ids (little-endian uint32)."""
    written = encoded(docs, path, end_id)
    totals = written.groupBy("part").agg(F.sum("n").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("_offset"))
    # one row per partition of the writing job
    placed = written.join(F.broadcast(offsets), "part").select(
        (F.col("_offset") + F.col("begin")).alias("at"), "n", "doc_id", "ids")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return placed.mapInArrow(_cut(window, with_ids), schema + ", ids binary" * with_ids)


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """sequence_id, ids (padded to the window unless the length is a power of
    two already), used: the sequences put together from their pieces."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most one window of ids
    joined = F.aggregate(parts, F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    used = F.sum("length")
    pad = F.when(F.pow(2, F.floor(F.log2(used))) == used, 0).otherwise(window - used)
    zero = pad_id.to_bytes(4, "little")
    return pieces.groupBy("sequence_id").agg(used.alias("used"), joined.alias("_ids"), pad.cast("int").alias("_pad")).select(
        "sequence_id", F.concat("_ids", F.unhex(F.expr(f"repeat('{zero.hex()}', _pad)"))).alias("ids"), "used")


def op8_query(docs: DataFrame) -> DataFrame:
    return pack(docs, with_ids=False)
