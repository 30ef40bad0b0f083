"""Lines that many documents share (operator 13).

1. Every text is split at newlines; a line's key is the line without ASCII
   white space at its ends and with A-Z lower-cased. Keys of at least
   ``min_chars`` code points are hashed to 128 bits.
2. Distinct documents are counted per hash, on (hash, document) first, so a
   line of a third of all documents is counted by every task.
3. Hashes of at least ``min_docs`` documents lose their lines in all but the
   largest doc_id that holds them. Lines meet this list by a join that
   broadcasts the heavy hashes (bounded in number) and shuffles the rest.
4. The dropped positions of a text go back to it, and its other lines are
   joined again in order.

Defined results: a null or empty text is one empty line; a row without a
doc_id counts as no document and loses every line over the threshold; rows
that repeat a doc_id are one document, each row loses lines by its own text;
a key that occurs several times in its last document keeps all lines there;
other columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.llm.common import slices, stored
from colloquy.operators.skew import lookup_join

MIN_CHARS = 40
MIN_DOCS = 5
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _hashed(value: Column, a: str, b: str) -> list[Column]:
    return [F.xxhash64(value).alias(a), F.xxhash64(F.lit(1), value).alias(b)]


def _row_id() -> list[Column]:
    return [F.col("doc_id").alias("_id"), *_hashed(F.col("text"), "_t1", "_t2")]


def _rebuilt(text_at: int, counted: bool):
    """Rows out of ``_row``, their text without the lines at the positions in
    ``_drop``; with ``counted``, the number of these lines behind."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = part.column(0)
                columns, names = rows.flatten(), [f.name for f in rows.type]
                drops = part.column(1).to_pylist()
                texts = []
                for text, drop in zip(columns[text_at].to_pylist(), drops):
                    if drop:
                        gone = set(drop)
                        text = "\n".join([s for i, s in enumerate((text or "").split("\n")) if i not in gone])
                    texts.append(text)
                columns[text_at] = pa.array(texts, columns[text_at].type)
                if counted:
                    columns, names = [*columns, pa.array([len(d or ()) for d in drops], pa.int64())], [*names, "dropped"]
                yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(names))])
    return run


def shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """(long lines of all texts, hashes over the threshold).

    Lines: _id, _t1, _t2 (the row), pos, k1, k2. Hashes: k1, k2, n_docs,
    last_doc (largest doc_id that holds it), n_lines."""
    rows = docs.select(*_row_id(), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("pos", "_line"))
    keyed = rows.withColumn("_key", line_key(F.col("_line"))).where(F.char_length("_key") >= min_chars)
    lines = keyed.select("_id", "_t1", "_t2", "pos", *_hashed(F.col("_key"), "k1", "k2"))
    per_doc = lines.groupBy("k1", "k2", "_id").agg(F.count(F.lit(1)).alias("n"))
    hashes = per_doc.groupBy("k1", "k2").agg(F.count("_id").alias("n_docs"), F.max("_id").alias("last_doc"), F.sum("n").alias("n_lines"))
    return lines, stored(hashes.where(F.col("n_docs") >= min_docs), "shared-lines")


def drop_shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, dropped_as: str | None = None) -> DataFrame:
    """``docs`` with shared lines removed from ``text`` (a null text stays
    null). ``dropped_as`` names a column to add: lines removed from the row."""
    lines, hashes = shared_lines(docs, min_chars, min_docs)
    met = lookup_join(lines, hashes.select("k1", "k2", "last_doc", "n_lines"), ["k1", "k2"], "n_lines", F.struct("_t1", "pos"))
    dropped = (met.where(F.col("last_doc").isNotNull() & ~F.col("_id").eqNullSafe(F.col("last_doc")))
               .groupBy("_id", "_t1", "_t2").agg(F.collect_set("pos").alias("_drop")))  # positions of one text
    row = docs.select(F.struct(*docs.columns).alias("_row"), *_row_id())  # a struct: no column of it can clash
    on = row["_id"].eqNullSafe(dropped["_id"]) & row["_t1"].eqNullSafe(dropped["_t1"]) & row["_t2"].eqNullSafe(dropped["_t2"])
    found = row.join(dropped, on, "left").select("_row", "_drop")
    out = T.StructType([*docs.schema.fields, *([T.StructField(dropped_as, T.LongType())] if dropped_as else [])])
    return found.mapInArrow(_rebuilt(docs.columns.index("text"), bool(dropped_as)), out)


def op13_query(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", "text", F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long").alias("n_lines"))
    return drop_shared_lines(rows, dropped_as="n_dropped").select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP13_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
shared AS (SELECT k, max(doc_id) AS last_doc FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT l.*, coalesce(l.doc_id <> s.last_doc, false) AS gone FROM keyed l LEFT JOIN shared s ON s.k = l.k)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
