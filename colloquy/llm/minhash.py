"""Near-duplicate documents by b-bit MinHash (operator 2).

1. Each text becomes its set of distinct word shingles (64-bit hashes), a
   fingerprint of that set, ``BANDS * ROWS`` minima, the band keys (hashes of
   ``ROWS`` whole minima) and the signature: the low ``BITS`` bits of every
   minimum, packed into longs.
2. Texts with equal sets form a class; one representative stands for it.
3. Representatives that share a band key are candidates. Two minima agree in
   their low bits by chance with probability c = 2^-BITS, so the similarity
   is estimated as (agreeing share - c) / (1 - c) from a bit count of the
   XORed signatures. Candidates clearly below the threshold (five standard
   errors) go; the others are confirmed on their full sets.
4. Two rounds compare every member of a bucket with one member drawn per
   bucket (rows linear in the members) and join what links. What is left of
   a bucket then holds few components; its pairs across components are
   compared block by block inside the tasks, and only pairs that pass the
   estimate are emitted and confirmed. Links inside a component cannot
   change it.

A pair at the threshold shares no band with probability
(1 - t^ROWS)^BANDS (5e-8 at 0.8 with 32 bands of 4).

Defined results: words are compared after lower-casing A-Z; a text with
fewer words than a shingle is one shingle of all its words; a null, empty or
blank text has an empty set and links with nothing; a row with a null doc_id
links with nothing, has no component and is kept; rows that repeat a text are
copies; rows of one doc_id with other texts are texts of their own, each with
the component of its text; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import cut, drop_stored, free_shuffles, stored
from colloquy.llm.components import connected_components
from colloquy.llm.runs import blocks, local_components, unit_runs
from colloquy.operators.indexing import dense_index

BANDS, ROWS, BITS = 32, 4, 4
BLOCK = 1024
MEMO = 200_000
STAR_ROUNDS = 2
_LOW = np.uint64(0x1111111111111111)


class _WordHashes(dict):
    def __missing__(self, word):
        if len(self) > MEMO:
            self.clear()
        v = self[word] = xxhash.xxh3_64_intdigest(word)
        return v


_MEMO = _WordHashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a whole text."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_MEMO.__getitem__, words), np.uint64, len(words))
    k = min(size, len(h))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - k + 1 + i])
    return np.unique(out)


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    return (rng.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64))


def minima(hashes: np.ndarray) -> np.ndarray:
    a, b = _multipliers_cached
    low = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for s in range(0, len(hashes), 1024):
        x = hashes[s:s + 1024, None] * a
        x += b
        np.minimum(low, x.min(0), out=low)
    return low >> np.uint64(32)


_multipliers_cached = _multipliers()


def pack(low: np.ndarray) -> np.ndarray:
    """Low bits of the minima, 64 // BITS of them in each long."""
    per = 64 // BITS
    bits = (low & np.uint64((1 << BITS) - 1)).reshape(-1, per)
    return np.bitwise_or.reduce(bits << (np.arange(per, dtype=np.uint64) * np.uint64(BITS)), axis=1).view(np.int64)


def band_keys(low: np.ndarray) -> np.ndarray:
    rows = low.reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for i in range(ROWS):
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, i])
    return key.view(np.int64)


def _features(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc, t1, t2, text in zip(pdf["doc_id"], pdf["t1"], pdf["t2"], pdf["text"]):
                h = shingle_hashes(text, size)
                if len(h):
                    low = minima(h)
                    rows.append((doc, t1, t2, len(h), hashlib.blake2b(h.tobytes(), digest_size=16).digest(),
                                 pack(low), band_keys(low)))
                else:
                    rows.append((doc, t1, t2, 0, None, None, None))
            yield pd.DataFrame(rows, columns=["doc_id", "t1", "t2", "n_shingles", "fp", "sig", "bands"])
        _MEMO.clear()  # workers live on
    return run


def _counts(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"n_shingles": [len(shingle_hashes(t, size)) for t in pdf["text"]]})
    return run


def _sets(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sets = [shingle_hashes(t, size) for t in pdf["text"]]
            same = [hashlib.blake2b(h.tobytes(), digest_size=16).digest() == bytes(fp) for h, fp in zip(sets, pdf["fp"])]
            out = pd.DataFrame({"rep": pdf["rep"], "hashes": [np.sort(h.view(np.int64)) for h in sets]})
            yield out[np.array(same, bool)]
        _MEMO.clear()
    return run


def estimate(agree: Column | np.ndarray):
    """Collision-corrected similarity from the number of agreeing minima."""
    c = 2.0 ** -BITS
    return (agree / float(BANDS * ROWS) - c) / (1 - c)


def _floor(threshold: float) -> float:
    """Lowest estimate that the threshold reaches within five standard errors."""
    c = 2.0 ** -BITS
    e = threshold * (1 - c) + c
    return threshold - 5 * (e * (1 - e) / (BANDS * ROWS)) ** 0.5 / (1 - c)


def _agreeing(a: str, b: str) -> Column:
    words = BANDS * ROWS * BITS // 64
    total = F.lit(0)
    for i in range(words):
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        for s in (1, 2):
            x = x.bitwiseOR(F.shiftrightunsigned(x, s))
        total = total + F.bit_count(x.bitwiseAND(F.lit(int(_LOW))))
    return F.lit(BANDS * ROWS) - total


_UNIT = ["key", "_i", "_j"]


def _candidates(pdf: pd.DataFrame, threshold: float) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per unit (begin, end) the pairs across components that can reach the
    threshold by size and estimate, in the first band that both share."""
    sig = np.stack(pdf["sig"].to_numpy()).view(np.uint64)
    bands = np.stack(pdf["bands"].to_numpy())
    comp, n, rep, key, chunk = (pdf[c].to_numpy() for c in ("comp", "n", "rep", "key", "_c"))
    ij = pdf[["_i", "_j"]].to_numpy()
    low = _floor(threshold)
    starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (ij[1:] != ij[:-1]).any(1)])
    for s, e in zip(starts, np.r_[starts[1:], len(pdf)]):
        i, j = ij[s]
        left = np.flatnonzero(chunk[s:e] == i) + s
        right = left if i == j else np.flatnonzero(chunk[s:e] == j) + s
        for at in range(0, len(left), 256):
            a = left[at:at + 256]
            ok = (comp[a][:, None] != comp[right][None, :]) & (
                np.minimum(n[a][:, None], n[right][None, :]) >= threshold * np.maximum(n[a][:, None], n[right][None, :]) - 1e-6)
            if i == j:
                ok &= rep[a][:, None] < rep[right][None, :]
            x, y = np.nonzero(ok)
            x, y = a[x], right[y]
            d = sig[x] ^ sig[y]
            d |= d >> np.uint64(1)
            d |= d >> np.uint64(2)
            agree = BANDS * ROWS - np.bitwise_count(d & _LOW).sum(1, dtype=np.int64)
            keep = estimate(agree) >= low
            x, y = x[keep], y[keep]
            first = bands[x, (bands[x] == bands[y]).argmax(1)] == key[x]
            if first.any():
                yield s, e, x[first], y[first]


def _to_confirm(threshold: float):
    """Rows of a unit that some candidate pair of the unit needs."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in unit_runs(batches, _UNIT):
            rows = [np.r_[x, y] for _, _, x, y in _candidates(pdf, threshold)]
            if rows:
                yield pdf[[*_UNIT, "_c", "rep", "comp", "n"]].iloc[np.unique(np.concatenate(rows))]
    return run


def _confirmed_links(threshold: float):
    """Candidates confirmed on their full sets, as one star per group of
    texts that a unit links."""
    percent = round(threshold * 100)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in unit_runs(batches, _UNIT):
            rep, hashes = pdf["rep"].to_numpy(), pdf["hashes"].to_numpy()
            found: list[tuple[int, int]] = []
            for _, _, x, y in _candidates(pdf, threshold):
                order = np.argsort(x, kind="stable")
                x, y = x[order], y[order]
                cuts = np.flatnonzero(np.r_[True, x[1:] != x[:-1], True])
                for s, e in zip(cuts[:-1], cuts[1:]):
                    own, others = hashes[x[s]], y[s:e]
                    sizes = np.array([len(hashes[o]) for o in others])
                    every = np.concatenate([hashes[o] for o in others])
                    at = np.minimum(np.searchsorted(own, every), len(own) - 1)
                    shared = np.add.reduceat((own[at] == every).astype(np.int64), np.cumsum(sizes) - sizes)
                    linked = 100 * shared >= percent * (len(own) + sizes - shared)
                    found += [(x[s], o) for o in others[linked]]
            if found:
                a, b = np.array(found).T
                root = local_components(len(pdf), a, b)
                # a text that several bands bring in has a row in each unit; units stay apart
                used = np.unique(np.r_[a, b])
                moved = used[root[used] != used]
                yield pd.DataFrame({"u": rep[moved], "v": rep[root[moved]]})
    return run


def _text_hashes() -> list[Column]:
    return [F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), F.col("text")).alias("t2")]


def _grouped(docs: DataFrame, shingle: int, threshold: float) -> DataFrame:
    """doc_id, t1, t2 (hashes of the text), n_shingles, group (node of the
    component, null for an empty set) and component_id of every row with a
    doc_id.

    The nodes are classes of texts with equal sets, named by their smallest
    doc_id. Where classes share that id, each gets a number above all ids
    instead, so that no two texts become one node."""
    percent = round(threshold * 100)
    feats = stored(docs.select("doc_id", *_text_hashes(), "text").mapInPandas(
        _features(shingle), "doc_id long, t1 long, t2 long, n_shingles long, fp binary, sig array<long>, bands array<long>"), "minhash")
    shown = F.col("fp").isNotNull()
    classes = stored(feats.where(shown).groupBy("fp")
                     .agg(F.min(F.struct("doc_id", "n_shingles", "sig", "bands")).alias("r"))
                     .select("fp", F.col("r.doc_id").alias("doc"), F.col("r.n_shingles").alias("n"), "r.sig", "r.bands"),
                     "minhash-classes")
    free_shuffles(docs.sparkSession)  # after each large step, so that the driver keeps none of its plans and metrics
    twice = classes.groupBy("doc").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("doc")
    top = classes.agg(F.coalesce(F.max("doc"), F.lit(0))).first()[0]
    numbered = stored(dense_index(classes.select("fp", "doc").join(twice, "doc"), ["doc", "fp"], "_at")
                      .select("fp", (F.col("_at") + F.lit(top + 1)).alias("_node")), "minhash-shared-ids")
    reps = classes.join(numbered, "fp", "left").withColumn("rep", F.coalesce("_node", "doc")).drop("_node")
    keyed = reps.select("rep", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("key")
    members = stored(keyed.join(shared, "key").distinct(), "minhash-buckets")
    free_shuffles(docs.sparkSession)
    involved = members.select("rep").distinct()
    brief = stored(reps.join(involved, "rep"), "minhash-involved")
    sets = stored(docs.join(brief.select("rep", "doc", "fp"), F.col("doc_id") == F.col("doc")).select("rep", "fp", "text")
                  .mapInPandas(_sets(shingle), "rep long, hashes array<long>"), "minhash-sets")
    free_shuffles(docs.sparkSession)

    def confirmed(pairs: DataFrame) -> DataFrame:
        full = (pairs.join(sets.select(F.col("rep").alias("a"), F.col("hashes").alias("_ha")), "a")
                .join(sets.select(F.col("rep").alias("b"), F.col("hashes").alias("_hb")), "b"))
        both = F.size(F.array_intersect("_ha", "_hb"))
        return full.where(100 * both >= percent * (F.size("_ha") + F.size("_hb") - both)).select(
            F.col("a").alias("u"), F.col("b").alias("v"))

    def labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
        if labels is None:
            return rows.withColumn("comp", F.col("rep"))
        return (rows.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
                .withColumn("comp", F.coalesce("component", "rep")).drop("component"))

    labels, edges = None, None
    for salt in range(STAR_ROUNDS):
        now = labelled(members, labels)
        drawn = (now.groupBy("key").agg(F.min(F.struct(F.xxhash64("rep", "key", F.lit(salt)).alias("h"), F.col("rep").alias("center"),
                                                       F.col("comp").alias("c_comp"))).alias("d"),
                                        F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                 .where("lo < hi").select("key", "d.center", "d.c_comp"))
        pairs = now.join(drawn, "key").where("comp <> c_comp").select(F.col("rep").alias("a"), F.col("center").alias("b")).distinct()
        scored = (pairs.join(brief.select(F.col("rep").alias("a"), F.col("n").alias("_na"), F.col("sig").alias("_sa")), "a")
                  .join(brief.select(F.col("rep").alias("b"), F.col("n").alias("_nb"), F.col("sig").alias("_sb")), "b")
                  .where(100 * F.least("_na", "_nb") >= percent * F.greatest("_na", "_nb"))
                  .withColumn("_e", estimate(_agreeing("_sa", "_sb"))).where(F.col("_e") >= _floor(threshold)))
        best = scored.groupBy("a").agg(F.max(F.struct("_e", "b")).alias("m")).select("a", F.col("m.b").alias("b"))
        best = cut(best)
        free_shuffles(docs.sparkSession)
        new = cut(confirmed(best))
        free_shuffles(docs.sparkSession)
        edges = new if edges is None else edges.unionAll(new)
        labels = connected_components(edges)
    rows = labelled(members, labels)
    mixed = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
    shape = brief.select("rep", "n", "sig", "bands")
    needed = cut(blocks(rows.join(mixed, "key"), ["key"], "rep", BLOCK, shape)
                 .select(*_UNIT, "_c", "rep", "comp", "n", "sig", "bands")
                 .mapInPandas(_to_confirm(threshold), "key long, _i int, _j int, _c int, rep long, comp long, n long"))
    free_shuffles(docs.sparkSession)
    full = (needed.join(shape.drop("n"), "rep").join(sets, "rep")
            .select(*_UNIT, "_c", "rep", "comp", "n", "sig", "bands", "hashes")
            .repartition(*_UNIT).sortWithinPartitions(*_UNIT))
    cross = full.mapInPandas(_confirmed_links(threshold), "u long, v long")
    labels = connected_components(edges.unionAll(cross))
    drop_stored(members, brief, sets)

    named = labelled(reps.select("fp", "doc", "rep"), labels).withColumnRenamed("comp", "group")
    # the least id of a component, where a number above all ids may hide it
    hidden = (named.join(numbered.select("fp"), "fp", "left_semi").groupBy("group").agg(F.min("doc").alias("_least")))
    ids = named.select("fp", "group").join(hidden, "group", "left").select(
        "fp", "group", F.least(F.when(F.col("group") <= top, F.col("group")), F.col("_least")).alias("component_id"))
    narrow = feats.select("doc_id", "t1", "t2", "n_shingles", "fp")
    linked = narrow.where(shown).join(ids, "fp").select("doc_id", "t1", "t2", "n_shingles", "group", "component_id")
    alone = narrow.where(~shown).select("doc_id", "t1", "t2", "n_shingles", F.lit(None).cast("long").alias("group"), F.col("doc_id").alias("component_id"))
    return linked.unionAll(alone)


def near_duplicates(docs: DataFrame, shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``
    (columns doc_id, text): components of the links with Jaccard similarity
    of at least ``threshold``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = _grouped(docs.where("doc_id is not null"), shingle, threshold).select("doc_id", "n_shingles", "component_id")
    none = F.lit(None).cast("long")
    lost = docs.where("doc_id is null").select("text").mapInPandas(_counts(shingle), "n_shingles long").select(
        none.alias("doc_id"), "n_shingles", none.alias("component_id"))
    return found.unionAll(lost).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """``docs`` with one row of each group: the one of least (doc_id, hash of
    the text), and of rows equal in both any one. Rows without a doc_id and
    every row without words stay."""
    row = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").cast("long").alias("_id"),
                      *[c.alias(f"_{n}") for c, n in zip(_text_hashes(), ("t1", "t2"))])
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null")
    groups = stored(_grouped(texts, shingle, threshold), "minhash-groups")  # read twice below
    free_shuffles(docs.sparkSession)
    first = (groups.where(F.col("group").isNotNull()).groupBy("group").agg(F.min(F.struct("doc_id", "t1", "t2")).alias("r"))
             .select("r.doc_id", "r.t1", "r.t2"))
    empty = groups.where(F.col("group").isNull()).select("doc_id", "t1", "t2").distinct()
    known = row.where("_id is not null")
    on = lambda k: (F.col("_id") == k["doc_id"]) & F.col("_t1").eqNullSafe(k["t1"]) & F.col("_t2").eqNullSafe(k["t2"])
    one = known.join(first, on(first), "left_semi").dropDuplicates(["_id", "_t1", "_t2"])
    return (one.unionAll(known.join(empty, on(empty), "left_semi")).unionAll(row.where("_id is null"))).select("_row.*")


def op2_query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, shingle=2, threshold=0.8)
