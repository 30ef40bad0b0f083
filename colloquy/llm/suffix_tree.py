"""Language-model scoring by a probabilistic suffix tree over words (operator 7).

Symbols are lower-cased (A-Z) words plus one end per text. A state is a
context of 0 to ``MAX_DEPTH`` words, an edge a state with its next symbol; a
text is scored by the longest state that is a suffix of what precedes each
symbol.

1. Texts are written once as blocks of about ``BLOCK_TOKENS`` tokens: a local
   vocabulary with training counts, and the tokens as local ids. The local
   vocabularies are summed to the counts of all words; words seen
   ``MIN_COUNT`` times get an id by falling count, so that a few steps (one
   per distinct count) tell the count of any id.
2. A window is a token with the words before it, nearest first, as far as a
   context may reach: ``MAX_DEPTH`` words, the start of the text, or a word
   without an id. All contexts of a token end in the same word, so windows are
   dealt by the nearest word to groups of about ``GROUP_TOKENS`` tokens, as one
   row of packed arrays a block and group; a group holds all that its contexts
   need. The number of groups grows with the corpus.
3. Frequent contexts, with more than ``1 / FREQUENT`` of a group's tokens, do
   not fit this. Their windows are dealt by the next word back (or evenly, where
   there is none) to as many groups as they need. Their counts of next symbols are
   summed by Spark and join those groups as windows with a weight. There are
   at most ``2 * FREQUENT`` of them a group and depth, by counting.
4. Contexts are lengthened word by word. A longer context is retained if its
   next-symbol distribution diverges from that of its parent:
   Kullback-Leibler divergence of ``MIN_DIVERGENCE`` nats and count times
   divergence of ``MIN_GAIN``. Only retained contexts are lengthened; levels end
   when none is left, or at ``MAX_DEPTH``.
5. Smoothing: absolute discounting. What a state takes from its own edges
   goes to all other symbols in proportion to the parent state. The root
   gives words (c - d) / N and the unknown word d * V / N.
6. What the states change in the scores returns to the blocks as sums a text.

Windows are dealt in ``SLICES`` steps, each of which frees its shuffle files.
The driver gets the steps of the word counts and the frequent contexts.

Defined results: a null, empty or blank text is its end alone; without
training texts every probability is 1 (score 0); a null doc_id hashes like
the empty text; repeated rows each count. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import crc32_bucket, drop_stored, free_shuffles, stored
from colloquy.operators.indexing import dense_index

BLOCK_TOKENS = 1_000_000
MIN_COUNT = 3
MIN_DIVERGENCE, MIN_GAIN = 0.005, 10.0
MAX_DEPTH = 6
SLICES = 3
SETTLE_S = 2.0  # large shuffle files are freed after so long, see free_shuffles
DISCOUNT = 0.75
END = b""  # a word is never empty
GROUP_TOKENS = 2_000_000
FREQUENT = 2
_CODEC = pa.Codec("zstd")

_BLOCK_SCHEMA = ("block long, words array<binary>, counts array<long>, doc_ids array<long>, "
                 "held array<boolean>, sizes array<long>, tokens binary")
_BODY_SCHEMA = ("block long, doc_ids array<long>, held array<boolean>, sizes array<long>, known array<long>, base array<double>, "
                "score array<double>, gids array<long>, tokens binary")
_WINDOW_SCHEMA = "part long, block long, k long, y binary, before binary, flag binary, text binary, n binary"
_REPLY_SCHEMA = "of long, k long, text binary, v binary"


class _Local(dict):
    def __missing__(self, word):
        v = self[word] = len(self)
        return v


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, n = TaskContext.get().partitionId(), 0
    open_ = None
    for batch in batches:
        texts = batch.column("text")
        for i, (doc, held) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("held").to_pylist())):
            if open_ is None:
                open_ = ([], [], [], [], _Local({END: 0}))
            docs, helds, sizes, tokens, local = open_
            text = texts[i].as_py()
            words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
            ids = np.fromiter(map(local.__getitem__, words), np.uint32, len(words))
            docs.append(doc)
            helds.append(held)
            sizes.append(len(words) + 1)
            tokens += [ids, np.zeros(1, np.uint32)]
            if sum_more(open_, len(words) + 1) >= BLOCK_TOKENS:
                yield _block(part, n, open_)
                open_, n = None, n + 1
    if open_:
        yield _block(part, n, open_)


def sum_more(open_, k: int) -> int:
    """Tokens of the open block so far (kept on its vocabulary)."""
    local = open_[4]
    local.tokens = getattr(local, "tokens", 0) + k
    return local.tokens


def _packed(values: np.ndarray) -> pa.Array:
    """Compressed with equal bytes of all values side by side."""
    planes = np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T)
    return pa.array([_CODEC.compress(planes, asbytes=True)], pa.binary())


def _block(part: int, n: int, open_) -> pa.RecordBatch:
    docs, helds, sizes, tokens, local = open_
    ids = np.concatenate(tokens)
    train = np.repeat(~np.array(helds, bool), sizes)
    counts = np.bincount(ids[train], minlength=len(local))
    one = lambda v, k: pa.array([v], pa.list_(k))
    return pa.RecordBatch.from_arrays(
        [pa.array([part * (1 << 32) + n], pa.int64()), one(list(local), pa.binary()), one(counts, pa.int64()), one(docs, pa.int64()),
         one(helds, pa.bool_()), one(sizes, pa.int64()), _packed(ids)],
        names=["block", "words", "counts", "doc_ids", "held", "sizes", "tokens"])


def _unpacked(value: pa.Scalar, kind, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(_CODEC.decompress(value.as_buffer(), size * n), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


class _Windows:
    """A block's tokens: ids (-1: none), their texts, whether training text."""

    def __init__(self, batch: pa.RecordBatch, i: int):
        get = lambda c: batch.column(c)[i].values.to_numpy(zero_copy_only=False)
        sizes = get("sizes")
        n = int(sizes.sum())
        self.ids = get("gids").astype(np.int32)[_unpacked(batch.column("tokens")[i], np.uint32, n)]
        self.text = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        self.place = np.arange(n, dtype=np.int32) - np.repeat((np.cumsum(sizes) - sizes).astype(np.int32), sizes)
        self.train = np.repeat(~get("held").astype(bool), sizes)

    def before(self, depth: int) -> Iterator[np.ndarray]:
        """Ids of the words before, the nearest first; -1 beyond the context."""
        reaches = np.ones(len(self.ids), bool)
        for k in range(1, depth + 1):
            words = np.full(len(self.ids), -1, np.int32)
            words[k:] = self.ids[:-k]
            reaches &= (self.place >= k) & (words >= 0)
            words[~reaches] = -1
            yield words


def _mixed(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A hash of each pair."""
    h = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + x.astype(np.uint64)
    for shift in (32, 29):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(0xBF58476D1CE4E5B9)
    return h >> np.uint64(16)


def _pairs(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    return (a.astype(np.int64) << np.int64(32)) | x.astype(np.int64)


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys and which of them each is; keys that are small
    numbers need no sort."""
    if len(keys) and keys.max() < 4 * len(keys):
        there = np.zeros(int(keys.max()) + 1, bool)
        there[keys] = True
        return np.flatnonzero(there), (np.cumsum(there) - 1)[keys]
    return np.unique(keys, return_inverse=True)


class _Frequent:
    """Contexts with more windows than a group should hold, numbered from 1 (0
    is the empty context), and the groups that windows are dealt to.
    ``found``: (words, nearest first, and their windows), parents included."""

    def __init__(self, found: list[tuple[tuple[int, ...], int]], groups: int, limit: int):
        found = sorted(found, key=lambda f: (len(f[0]), f[0]))
        number = {(): 0} | {path: i for i, (path, _) in enumerate(found, 1)}
        self.paths = list(number)
        self.groups = groups
        self.parents = np.array([number[path[:-1]] for path in self.paths], np.int64)
        self.spread = np.array([groups, *(min(groups, 1 + 2 * n // limit) for _, n in found)], np.int64)
        ids = np.arange(len(self.paths))
        self.start = np.where(ids > 0, _mixed(ids, ids) % np.uint64(groups), 0).astype(np.int64)
        keys = _pairs(self.parents[1:], np.array([path[-1] for path, _ in found], np.int64))
        order = np.argsort(keys)
        self.keys, self.numbers = keys[order], order + 1
        self.depth = max(map(len, self.paths))
        self.lots = 1 + sum(n for _, n in found) // GROUP_TOKENS
        self.targets = [set() for _ in self.paths]  # groups with windows of a frequent context
        for i in ids[:0:-1].tolist():
            mine = self.targets[i]
            mine.update(((self.start[i] + np.arange(self.spread[i])) % groups).tolist())
            if self.parents[i]:
                self.targets[self.parents[i]] |= mine

    def longest(self, before: Iterable[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
        """(number, length) of the longest frequent context of ``n`` windows."""
        number, length = np.zeros(n, np.int64), np.zeros(n, np.int8)
        live = np.arange(n)
        for k, words in zip(range(self.depth), before):
            keys = _pairs(number[live], words[live])
            live = live[(words[live] >= 0) & (keys <= self.keys[-1])]
            keys = _pairs(number[live], words[live])
            i = np.searchsorted(self.keys, keys)
            hit = self.keys[i] == keys
            live = live[hit]
            number[live], length[live] = self.numbers[i[hit]], k + 1
        return number, length

    def group(self, before: np.ndarray, number: np.ndarray, length: np.ndarray) -> np.ndarray:
        places = np.arange(before.shape[1])
        word = np.where(length < len(before), before[np.minimum(length, len(before) - 1), places], -1)
        h = _mixed(number, np.where(word >= 0, word, places + (1 << 32)))
        return (self.start[number] + (h % self.spread[number].astype(np.uint64)).astype(np.int64)) % self.groups


def _often(depth: int, blocks: int, limit: int):
    """(path, n) of contexts that may be frequent. Where all blocks together
    have more than ``limit`` windows of one, those named have more than half."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                windows, paths = _Windows(batch, i), [()]
                live, number = np.arange(len(windows.ids)), np.zeros(len(windows.ids), np.int64)
                for words in windows.before(depth):
                    live = live[words[live] >= 0]
                    keys, which = _numbered(_pairs(number[live], words[live]))
                    n = np.bincount(which, minlength=len(keys))
                    often = n * blocks * 2 > limit
                    paths = [paths[k >> 32] + (k & ((1 << 32) - 1),) for k in keys[often].tolist()]
                    if not paths:
                        break
                    yield pa.RecordBatch.from_arrays([pa.array([list(p) for p in paths], pa.list_(pa.int64())), pa.array(n[often])], names=["path", "n"])
                    live, which = live[often[which]], which[often[which]]
                    number[live] = (np.cumsum(often) - 1)[which]
    return run


def _next_symbols(frequent: _Frequent):
    """Training counts of the symbols after frequent contexts, as one row of
    packed arrays a block and lot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                windows, found = _Windows(batch, i), []
                number, _ = frequent.longest(windows.before(frequent.depth), len(windows.ids))
                at = np.flatnonzero(windows.train & (number > 0))
                keys, which = _numbered(_pairs(number[at], windows.ids[at] + 1))
                n = np.bincount(which, minlength=len(keys))
                while len(keys):
                    found.append((keys, n))
                    context = frequent.parents[keys >> np.int64(32)]
                    inner = context > 0
                    keys, which = _numbered(_pairs(context[inner], keys[inner] & _LOW))
                    n = np.bincount(which, n[inner], len(keys)).astype(np.int64)
                if found:
                    keys, n = (np.concatenate(v) for v in zip(*found))
                    lot = (_mixed(keys >> np.int64(32), keys & _LOW) % np.uint64(frequent.lots)).astype(np.int64)
                    for j in np.unique(lot).tolist():
                        mine = np.flatnonzero(lot == j)
                        yield pa.RecordBatch.from_arrays([pa.array([j], pa.int64()), pa.array([len(mine)], pa.int64()), _packed(keys[mine]), _packed(n[mine])],
                                                         names=["lot", "k", "keys", "n"])
    return run


_LOW = np.int64((1 << 32) - 1)


def _row(part: int, block: int | None, y, before, flag, text, n) -> pa.RecordBatch:
    none = pa.array([None], pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int64()), pa.array([block], pa.int64()), pa.array([len(y)], pa.int64()), _packed(y + 1), _packed((before + 1).reshape(-1)),
         _packed(flag.astype(np.uint8)), none if text is None else _steps(text), none if n is None else _packed(n)],
        names=["part", "block", "k", "y", "before", "flag", "text", "n"])


def _weighted(depth: int, frequent: _Frequent):
    """Counted symbols of frequent contexts as windows for the groups that
    need them. Symbols that are no edge of a frequent context are none of a
    longer one: one window a context for their sum."""
    def run(lots: pa.Table) -> pa.Table:
        read = lambda c: np.concatenate([_unpacked(v, np.int64, k.as_py()) for v, k in zip(lots.column(c), lots.column("k"))])
        keys, which = np.unique(read("keys"), return_inverse=True)
        n = np.bincount(which, read("n"), len(keys))
        keys, which = np.unique(np.where(n >= MIN_COUNT, keys, keys & ~_LOW), return_inverse=True)
        n = np.bincount(which, n, len(keys)).astype(np.int64)
        context, y = keys >> np.int64(32), ((keys & _LOW) - 1).astype(np.int32)
        paths = np.array([(*path, *(-1,) * (depth - len(path))) for path in frequent.paths], np.int32).reshape(-1, depth)
        lengths = (paths >= 0).sum(axis=1)
        for_group = np.zeros((len(paths), frequent.groups), bool)
        for c in np.unique(context).tolist():
            for_group[c, list(frequent.targets[c])] = True
        out = []
        for g in np.flatnonzero(for_group.any(axis=0)).tolist():
            mine = for_group[context, g]
            out.append(_row(g, None, y[mine], paths[context[mine]].T, 2 * lengths[context[mine]], None, n[mine]))
        return pa.Table.from_batches(out)
    return run


def _dealt(depth: int, frequent: _Frequent, step: int):
    """The windows of a block for the groups of one step, a row each. flag:
    length of the shortest context that is not frequent, and whether training text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                windows = _Windows(batch, i)
                before = np.stack(list(windows.before(depth)))
                number, length = frequent.longest(before, len(windows.ids))
                group = frequent.group(before, number, length)
                flag = 2 * (length + 1) + windows.train
                at = np.flatnonzero((before[0] >= 0) & (group % SLICES == step))
                at = at[np.argsort(group[at].astype(np.min_scalar_type(frequent.groups)), kind="stable")]
                ends = np.flatnonzero(np.diff(group[at], append=-1)) + 1
                block, start = batch.column("block")[i].as_py(), 0
                for end in ends.tolist() if len(at) else ():
                    mine = at[start:end]
                    yield _row(int(group[mine[0]]), block, windows.ids[mine], before[:, mine], flag[mine], windows.text[mine], None)
                    start = end
    return run


def _steps(at: np.ndarray) -> pa.Array:
    """Rising positions, packed as differences."""
    return _packed(np.diff(at, prepend=0).astype(np.int32))


def _scored(depth: int, root):
    """What the states of a group change in the log10 scores of its texts."""
    def run(chunks: pa.Table) -> pa.Table:
        chunks = chunks.combine_chunks()
        sizes = chunks.column("k").to_numpy()
        read = lambda c, kind: [_unpacked(v, kind, k) if v.is_valid else None for v, k in zip(chunks.column(c), sizes.tolist())]
        y = np.concatenate(read("y", np.int32)) - 1
        before = np.concatenate([_unpacked(v, np.int32, depth * k).reshape(depth, k) for v, k in zip(chunks.column("before"), sizes.tolist())], axis=1) - 1
        flags, counts = read("flag", np.uint8), read("n", np.int64)
        weight = np.concatenate([f & 1 if n is None else n for f, n in zip(flags, counts)])
        change = _changes(y, before, weight, np.concatenate(flags) >> 1, root)
        out = [pa.RecordBatch.from_arrays([pa.array([], k) for k in (pa.int64(), pa.int64(), pa.binary(), pa.binary())], names=["of", "k", "text", "v"])]
        ends = np.cumsum(sizes)
        for block, text, start, end in zip(chunks.column("block").to_pylist(), read("text", np.int32), (ends - sizes).tolist(), ends.tolist()):
            if block is not None:
                first = np.flatnonzero(np.r_[True, text[1:] != 0])
                v = np.add.reduceat(change[start:end], first)
                text = np.cumsum(text)[first][v != 0]
                out.append(pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([len(text)], pa.int64()), _steps(text), _packed(v[v != 0])],
                                                      names=["of", "k", "text", "v"]))
        return pa.Table.from_batches(out)
    return run


def _changes(y: np.ndarray, before: np.ndarray, weight: np.ndarray, counts_from: np.ndarray, root) -> np.ndarray:
    """Per window, log10 of its symbol's probability after the longest state
    less that after the root. A window counts with its weight in contexts of
    ``counts_from`` words or more. root: ids to (share, probability)."""
    change = np.zeros(len(y))
    at, state, edge = np.arange(len(y)), np.zeros(len(y), np.int64), y >= 0
    q, p = root(y)
    for k, words in enumerate(before, 1):
        longer = words[at] >= 0
        at, state, edge, q, p = (v[longer] for v in (at, state, edge, q, p))
        if not len(at):
            break
        n = np.where(counts_from[at] <= k, weight[at], 0)
        contexts, context = _numbered(_pairs(state, words[at]))
        m = np.bincount(context, n, len(contexts))
        live = np.flatnonzero(edge)
        grams, gram = _numbered(_pairs(context[live], y[at[live]]))
        seen = np.bincount(gram, n[live], len(grams))
        one = np.empty(len(grams), np.int64)
        one[gram] = live  # a window of each gram
        stays = seen >= MIN_COUNT
        kept, factor = _retained(m, context[one[stays]], seen[stays], q[one[stays]], p[one[stays]])
        here = kept[context]
        edge[live] = stays[gram]
        found = np.flatnonzero(edge[live] & here[live])
        found, n = live[found], seen[gram[found]]
        m = m[context[found]]
        deeper = (n - DISCOUNT) / m
        step = np.where(here, np.log10(np.where(kept, factor, 1.0))[context], 0.0)
        step[found] = np.log10(deeper / p[found])
        change[at] += step
        q[found], p[found] = n / m, deeper
        at, state, edge, q, p = (v[here] for v in (at, context, edge, q, p))
    return change


def _retained(m: np.ndarray, context: np.ndarray, n: np.ndarray, q: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which contexts are retained, and what each leaves to its parent. m:
    their counts; context, n, q, p: of their edges, with count, and share and
    probability in the parent state."""
    total = lambda v: np.bincount(context, v, len(m))
    edges, own, cross, q, p = total(np.ones(len(n))), total(n), total(n * np.log(n / q)), total(q), total(p)
    some = edges > 0
    m = np.where(some, m, 1.0)
    rest = 1 - own / m
    kl = (cross - own * np.log(m)) / m
    kl += np.where(rest > 1e-12, rest * np.log(np.maximum(rest, 1e-12) / np.maximum(1 - q, 1e-12)), 0.0)
    return some & (kl >= MIN_DIVERGENCE) & (kl * m >= MIN_GAIN), (1 - (own - DISCOUNT * edges) / m) / np.maximum(1 - p, 1e-9)


def _root(steps: list, total: int, discount: float):
    """Share and probability of words after the empty context; steps: rising
    (first id, count of the ids from it on)."""
    first, count = (np.array(v, np.int64) for v in zip(*steps))

    def root(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        distinct, which = _numbered(np.maximum(ids, 0))
        c = count[np.searchsorted(first, distinct, side="right") - 1][which]
        return c / total, (c - discount) / total
    return root


def _body_table(row: dict) -> pa.Table:
    kinds = {"block": pa.int64(), "doc_ids": pa.list_(pa.int64()), "held": pa.list_(pa.bool_()), "sizes": pa.list_(pa.int64()),
             "known": pa.list_(pa.int64()), "base": pa.list_(pa.float64()), "score": pa.list_(pa.float64()), "gids": pa.list_(pa.int64()),
             "tokens": pa.binary()}

    def column(name, kind):
        value = row[name]
        if isinstance(value, pa.Scalar):
            return pa.array([value.as_py()], kind) if not pa.types.is_list(kind) else pa.ListArray.from_arrays([0, len(value.values)], value.values)
        if pa.types.is_list(kind):
            return pa.ListArray.from_arrays([0, len(value)], pa.array(value, kind.value_type))
        return _packed(value)
    return pa.Table.from_arrays([column(c, k) for c, k in kinds.items()], names=list(kinds))


def _named(total: int, vocabulary: int, discount: float):
    """A block at depth 0, from the counts and ids of its words."""
    def run(blocks: pa.Table, named: pa.Table) -> pa.Table:
        row = {c: blocks.combine_chunks().column(c)[0] for c in blocks.column_names}
        sizes = row["sizes"].values.to_numpy(zero_copy_only=False)
        tokens = _unpacked(row["tokens"], np.uint32, int(sizes.sum()))
        width = int(tokens.max()) + 1
        c, gids = np.zeros(width, np.int64), np.full(width, -1, np.int64)
        at = named.column("id").to_numpy()
        c[at], gids[at] = named.column("c").to_numpy(), named.column("gid").to_numpy()
        base = np.log10((c + 1) / (total + vocabulary + 1))
        root = np.log10(np.where(c > 0, c - discount, discount * vocabulary) / total) if total else np.zeros(width)
        first = np.cumsum(sizes) - sizes
        sums = [np.add.reduceat(v[tokens], first) for v in ((c > 0).astype(np.int64), base, root)]
        return _body_table({**row, **dict(zip(("known", "base", "score"), sums)), "gids": gids})
    return run


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _results(total: int):
    def run(heads: pa.Table, replies: pa.Table) -> pa.Table:
        doc, held, sizes, known, base, score = (heads.column(c).combine_chunks().values for c in ("doc_ids", "held", "sizes", "known", "base", "score"))
        score = score.to_numpy().copy()
        for k, text, v in zip(*(replies.column(c) for c in ("k", "text", "v"))):
            score[np.cumsum(_unpacked(text, np.int32, k.as_py()))] += _unpacked(v, np.float64, k.as_py())
        return pa.table([doc, held, sizes, known, pa.array(np.full(len(doc), total, np.int64)), base, pa.array(score)],
                        names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def frequent_contexts(body: DataFrame, depth: int, blocks: int, groups: int, limit: int) -> _Frequent:
    """Contexts with more than ``limit`` windows (some with half of it)."""
    rows = (body.select("block", "sizes", "held", "gids", "tokens").mapInArrow(_often(depth, blocks, limit), "path array<long>, n long")
            .groupBy("path").agg(F.sum("n").alias("n")).where(F.col("n") * 2 > limit).collect())
    return _Frequent([(tuple(r.path), r.n) for r in rows], groups, limit)


def score_texts(docs: DataFrame, held_out, max_depth: int | None = None) -> DataFrame:
    """Scores of all texts under the tree learned from those not held out."""
    depth = MAX_DEPTH if max_depth is None else max_depth
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out.alias("held"))
    blocks = stored(rows.mapInArrow(_to_blocks, _BLOCK_SCHEMA), "tree-blocks")
    local = blocks.select(F.explode(F.arrays_zip("words", "counts")).alias("w"))
    counts = stored(local.groupBy(F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("c")).where("c > 0"), "tree-words")
    total, vocabulary, n1, n2 = (int(x or 0) for x in counts.agg(
        F.sum("c"), F.count(F.lit(1)), F.sum((F.col("c") == 1).cast("long")), F.sum((F.col("c") == 2).cast("long"))).first())
    discount = min(max(n1 / (n1 + 2 * n2), 0.1), 0.9) if n1 else 0.5
    often = counts.where(F.col("c") >= MIN_COUNT)
    steps, ids = [], 0
    for c, k in often.groupBy("c").count().orderBy(F.desc("c")).collect():
        steps.append((ids, c))
        ids += k
    if ids >= 1 << 31:
        raise ValueError("more than 2**31 words to tell apart")
    free_shuffles(counts.sparkSession, SETTLE_S)
    with_ids = dense_index(often, [F.desc("c"), "word"], "gid").unionByName(counts.where(F.col("c") < MIN_COUNT).withColumn("gid", F.lit(-1).cast("long")))

    named = stored(blocks.select("block", F.posexplode("words").alias("id", "word")).join(with_ids, "word")
                   .select(F.col("block").alias("of"), "id", "c", "gid"), "tree-named")
    drop_stored(counts, wait=SETTLE_S)
    body = stored(blocks.select("block", "doc_ids", "held", "sizes", "tokens").groupBy("block").cogroup(named.groupBy("of"))
                  .applyInArrow(_named(total, vocabulary, discount), _BODY_SCHEMA), "tree-body")
    n_blocks, tokens = body.agg(F.count(F.lit(1)), F.sum(F.expr("aggregate(sizes, 0L, (s, k) -> s + k)"))).first()
    drop_stored(blocks, named, wait=SETTLE_S)
    replies = body.sparkSession.createDataFrame([], _REPLY_SCHEMA)
    if steps and depth:
        for part in _replies(body, depth, _root(steps, total, discount), n_blocks, -(-tokens // GROUP_TOKENS)):
            replies = replies.unionAll(part)
    heads = body.select("block", "doc_ids", "held", "sizes", "known", "base", "score")
    return heads.groupBy("block").cogroup(replies.groupBy("of")).applyInArrow(_results(total), _SCORES)


def _replies(body: DataFrame, depth: int, root, blocks: int, groups: int) -> Iterator[DataFrame]:
    """Per block and group, what its texts gain; one table a step."""
    frequent = frequent_contexts(body, depth, blocks, groups, GROUP_TOKENS // FREQUENT)
    arrays = body.select("block", "sizes", "held", "gids", "tokens")
    symbols = arrays.mapInArrow(_next_symbols(frequent), "lot long, k long, keys binary, n binary")
    weighted = stored(symbols.groupBy("lot").applyInArrow(_weighted(depth, frequent), _WINDOW_SCHEMA), "tree-frequent")
    for step in range(SLICES):
        mine = stored(weighted.where(F.col("part") % SLICES == step), "tree-weighted")
        windows = arrays.mapInArrow(_dealt(depth, frequent, step), _WINDOW_SCHEMA).unionAll(mine)
        yield stored(windows.groupBy("part").applyInArrow(_scored(depth, root), _REPLY_SCHEMA), "tree-replies")
        drop_stored(mine, wait=SETTLE_S)  # and the shuffle files of the step
    drop_stored(weighted)


def op7_query(docs: DataFrame) -> DataFrame:
    return score_texts(docs, crc32_bucket(F.col("doc_id"), 7) == 2)
