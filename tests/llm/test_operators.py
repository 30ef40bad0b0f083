"""Operators against brute force on small fixtures with nulls, empty and long
texts, ties, repeated rows, empty tables and clashing extra columns."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from colloquy.llm import (capdedup, chatfmt, langid, minhash, mixing, packing, quality, suffix_tree, topk,
                          wordpiece)
from colloquy.llm.components import connected_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, size string, kept string, n_tokens string"


def frame(spark, rows):
    """rows of (doc_id, text, lang, source); the other columns only clash."""
    return spark.createDataFrame([(*r, len(r[1] or ""), 0.5, "x", "y", "z") for r in rows], DOCS)


def words(text):
    return (text or "").encode().lower().split()


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choice(vocabulary, 60)) for _ in range(40)]
    out = [(i, t, ["en", "de"][i % 2], f"s{i % 4}") for i, t in enumerate(base)]
    for i in range(40, 60):  # near copies
        w = base[i - 40].split()
        w[3] = "changed"
        out.append((i, " ".join(w), "en", "s0"))
    out += [(60, None, "en", "s1"), (61, "", None, None), (62, " \n\t", "de", "s1"), (63, "one", None, "s2"), (64, "one", "en", "s2"),
            (65, base[0], "en", "s3"), (65, base[0], "en", "s3"), (None, base[1], "en", "s0"), (66, "x " * 30_000, "en", "s1"),
            (67, "ÄÖ été ñ 中文 𝒳 \x1c a", "de", None), (68, "!!! 123", "en", "s0")]
    return out


# ------------------------------------------------------------------ 1
def test_mix_meets_targets(spark, rows):
    got = mixing.op1_query(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for d, t, _, s in rows:
        sizes[s] += len(words(t))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    budget, target, open_ = 1.5 * sum(sizes.values()), {}, set(order)
    while open_:  # water filling, round by round
        level = (budget - sum(target.values())) / sum(weights[s] for s in open_)
        full = {s for s in open_ if weights[s] * level >= 2 * sizes[s]}
        target |= {s: 2 * sizes[s] for s in full} or {s: weights[s] * level for s in open_}
        open_ = open_ - full if full else set()
    by_doc = {d: s for d, _, _, s in rows}
    taken = defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 2 * r["size"] and r.source_size == sizes[by_doc[r.doc_id]]
        assert r.target == pytest.approx(target[by_doc[r.doc_id]])
        taken[by_doc[r.doc_id]] += r.taken
    assert all(abs(taken[s] - target[s]) <= 2 for s in sizes)
    again = mixing.op1_query(frame(spark, rows[::-1]).repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_apply_mix_copies_and_cuts(spark, rows):
    docs = frame(spark, rows)
    mixed = mixing.mix(docs)
    out = mixing.apply_mix(docs, mixed)
    assert out.columns == docs.columns
    want, have = Counter(), Counter()
    for r in mixing.mix_rows(mixed).collect():
        want[(r.doc_id, r.source)] += r.taken
    for r in out.collect():
        have[(r.doc_id, r.source)] += len(words(r.text))
        assert r.n_chars == len(r.text)
    assert have == +want
    empty = docs.limit(0)
    assert mixing.op1_query(empty).count() == 0 and mixing.apply_mix(empty, mixing.mix(empty)).count() == 0


# ------------------------------------------------------------------ 2
def brute_groups(rows, size, percent):
    sets = []
    for d, t, *_ in rows:
        w = words(t)
        k = min(size, len(w))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set())
    label = list(range(len(rows)))

    def find(a):
        while label[a] != a:
            a = label[a]
        return a
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if rows[a][0] is not None and rows[b][0] is not None and both and \
                    100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                label[max(find(a), find(b))] = min(find(a), find(b))
    members = defaultdict(list)
    for a in range(len(rows)):
        members[find(a)].append(rows[a][0])
    return Counter((rows[a][0], len(sets[a]), None if rows[a][0] is None else min(members[find(a)])) for a in range(len(rows)))


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(spark, rows, size):
    got = minhash.near_duplicates(frame(spark, rows), shingle=size).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_groups(rows, size, 80)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def test_near_duplicates_across_hot_blocks(spark, monkeypatch):
    """A group whose texts link only through few others, in more than one block."""
    rng = np.random.default_rng(1)
    base, out = [f"b{i}" for i in range(100)], []
    for i in range(90):
        w = list(base)
        for j in rng.choice(100, rng.integers(1, 9), replace=False):
            w[j] = f"n{i}_{j}"
        out.append((i, " ".join(w), "en", "s"))
    monkeypatch.setattr(minhash, "BLOCK", 16)
    got = minhash.near_duplicates(frame(spark, out), shingle=2).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_groups(out, 2, 80)


def test_keep_one_and_empty(spark, rows):
    docs = frame(spark, rows)
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    groups = {c for _, _, c in brute_groups(rows, 5, 80) if c is not None}
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(groups)
    assert kept.where("doc_id is null").count() == 1
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_estimate_is_near_the_similarity():
    a = minhash.shingle_hashes(" ".join(f"w{i}" for i in range(1000)), 2)
    b = np.sort(np.r_[a[:800], minhash.shingle_hashes(" ".join(f"v{i}" for i in range(200)), 2)])
    agree = (minhash.minima(a) % 16 == minhash.minima(b) % 16).sum()
    true = 800 / len(np.union1d(a, b))
    assert abs(minhash.estimate(agree) - true) < 0.2


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "u long, v long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


# ------------------------------------------------------------------ 3
def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 40)
    monkeypatch.setattr(topk, "TILE_C", 16)
    rng = np.random.default_rng(0)
    x = (rng.integers(-40, 40, (150, 21)) / 16).tolist()
    x[41] = x[40]
    data = [(i, v, i) for i, v in enumerate(x)] + [
        (200, None, 1), (201, [1.0, None], 1), (202, [float("nan")] * 21, 1), (203, [], 1), (None, x[0], 1), (260, [1.0, 2.0], 1), (60, x[60], 0)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, rank int")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.op3_query(df).collect()}
    ints = {i: np.floor(64 * np.array(v)).astype(int) for i, v in enumerate(x)}
    for q in range(0, 150, 20):
        other = [(-int(ints[q] @ v), i) for i, v in ints.items() if i != q]
        other += [(-int(ints[q] @ ints[60]), 60)] if q != 60 else []  # the repeated row
        for n, (s, i) in enumerate(sorted(other)[:20], 1):
            assert got[(q, n)] == (i, -s)
    assert (260, 1) not in got and len(got) == 8 * 20
    assert topk.op3_query(df.limit(0)).count() == 0


# ------------------------------------------------------------------ 4
def test_language_id(spark, rows):
    en, de = "the cat and the dog went with them", "der hund und die katze gingen mit ihnen"
    train = [(i, f"{(en, de)[i % 2]} {i}", ("en", "de")[i % 2], "s") for i in range(100)]
    extra = [(100, None, "en", "s"), (101, "", "de", "s"), (102, "1 2 !", "en", "s"), (103, en * 3000, None, "s"), (None, de, None, "s")]
    got = {r.doc_id: r for r in langid.op4_query(frame(spark, train + extra)).collect()}
    for i in range(100):
        assert got[i].lang_pred == ("en", "de")[i % 2] and 0.5 < got[i].score <= 1
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
    assert [(got[i].lang_pred, got[i].score) for i in (100, 101, 102)] == [("und", 0.0)] * 3
    assert got[103].lang_pred == "en" and got[None].lang_pred == "de" and got[None].held_out
    none = frame(spark, [(1, "abc", None, "s")])
    assert langid.op4_query(none).collect()[0].lang_pred == "und" and langid.op4_query(none.limit(0)).count() == 0
    kept = langid.keep_known(frame(spark, train + extra))
    assert kept.columns == DOCS.replace(" long", "").replace(" string", "").replace(" double", "").split(", ")
    assert {r.doc_id for r in kept.collect()} == {*range(100), 103, None}


# ------------------------------------------------------------------ 5
CHATS = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 5, "assistant", None), (1, 4, None, "hi"),
         (1, 4, "user", "\\</s> \\\\[ROLE] x \\"), (1, None, "system", "first"), (2, 0, "system", "<s> be [/ROLE] kind"),
         *[(2, i, ("user", "assistant")[i % 2], f"turn {i} " + "word " * (37 * i % 90)) for i in range(1, 200)],
         (3, 0, "assistant", "same"), (3, 0, "assistant", "same"), (4, 0, "user", "word " * 5000), (4, 1, "assistant", "y"), (None, 0, "user", "z")]


def test_chat_format_reads_back(spark):
    df = spark.createDataFrame([(*r, "clash") for r in CHATS], "conv_id long, turn long, role string, text string, window string").repartition(5)
    windows = chatfmt.format_chats(df)
    got = {r.conv_id: r for r in chatfmt.read_back(windows).collect()}
    want = defaultdict(list)
    for c, t, r, x in sorted(CHATS, key=lambda v: (v[0] is not None, v[0] or 0, v[1] is not None, v[1] or 0, v[2] or "", v[3] or "")):
        want[c].append((r or "", x or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        loss = "".join(x for r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns) and got[c].loss_chars == len(loss)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    rows = windows.where("conv_id = 2").orderBy("window").collect()
    assert len(rows) > 5 and all(chatfmt.read_turns(r.formatted)[0] == ("system", "<s> be [/ROLE] kind") for r in rows)
    assert any(r.n_repeated > 1 for r in rows)
    assert chatfmt.read_back(chatfmt.format_chats(df.limit(0))).count() == 0


def test_chat_format_across_partitions(spark):
    """Conversations over many partitions, which a small table would not have:
    the windows are those of a single partition."""
    df = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string")
    found = []
    for n in ("1", "13"):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            found.append(sorted(map(str, chatfmt.format_chats(df).collect())))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found[0] == found[1] and len(found[0]) > 10


def test_escape_is_reversible():
    for text in ("", "\\", "<s>", "\\<s>", "\\\\</s>\\", "<<s>>", "[INST][/INST][ROLE]", "a\\[/ROLE] b", "</s> </s>"):
        turn, at, n = chatfmt.render(text, text)
        assert chatfmt.unescape(chatfmt.escape(text)) == text and chatfmt.read_turns(turn * 2) == [(text, text)] * 2
        assert chatfmt.unescape(turn[at:at + n]) == text


# ------------------------------------------------------------------ 6
def test_quality_classifier(spark):
    rng = np.random.default_rng(5)
    plain = [f"w{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(600):
        w = list(rng.choice(plain, 40))
        if i % 3 == 0:
            w = [f"{x.upper()}!!" for x in w]
        if i % 3 == 1:
            w[5] = "vile"
        docs.append((i, " ".join(w), "en", "s"))
        if i < 400:
            labels.append((i, int(i % 3 != 0), int(i % 3 == 1)))
    docs += [(1000, None, "en", "s"), (1001, "", "en", "s"), (None, "w1 w2", "en", "s"), (1002, "w3 " * 20_000, "en", "s")]
    labels += [(None, 1, 0), (5, None, 1), (2, 1, None)]
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    df = frame(spark, docs)
    got = {r.doc_id: r for r in quality.op6_query(df, lab).collect()}
    assert len(got) == 604
    right = [got[i].kept == (i % 3 == 2) for i in range(400, 600)]
    assert np.mean(right) > 0.95
    assert all(0 <= r.tail_prob <= 1 and 0 <= r.expected_grade <= 2 for r in got.values())
    kept = quality.keep_good(df, lab)
    assert kept.columns == df.columns and kept.where("doc_id = 400").count() == 0
    unrated = quality.op6_query(df, lab.limit(0)).collect()
    assert all(r.kept and r.tail_prob is None for r in unrated)
    assert quality.op6_query(df.limit(0), lab).count() == 0


# ------------------------------------------------------------------ 7
def brute_tree(texts, held):
    """The same suffix tree with dictionaries: (results, retained contexts)."""
    seqs = [[*words(t), b""] for t in texts]
    train = [s for s, h in zip(seqs, held) if not h]
    c = Counter(w for s in train for w in s)
    n, v = sum(c.values()), len(c)
    n1, n2 = (sum(x == k for x in c.values()) for k in (1, 2))
    d = min(max(n1 / (n1 + 2 * n2), 0.1), 0.9) if n1 else 0.5
    least = suffix_tree.MIN_COUNT
    root = lambda w: (c[w] - d) / n if c[w] else d * v / n
    # context -> ({symbol: (count, probability)}, count of the context, factor)
    tree = {(): ({w: (x, root(w)) for w, x in c.items() if x >= least}, n, None)}
    level = [()]
    for depth in range(1, suffix_tree.MAX_DEPTH + 1):
        count, nxt = Counter(), defaultdict(Counter)
        for s in train:
            for i in range(depth, len(s)):
                ctx = tuple(s[i - depth:i])
                if ctx[1:] in level:
                    count[ctx] += 1
                    nxt[ctx][s[i]] += 1
        found = []
        for ctx, m in count.items():
            parent, parent_m, _ = tree[ctx[1:]]
            own = {w: x for w, x in nxt[ctx].items() if x >= least}
            if c[ctx[0]] < least or not own:
                continue
            q = {w: parent[w][0] / parent_m for w in own}
            kl = sum(x / m * math.log(x / m / q[w]) for w, x in own.items())
            rest, rest_q = 1 - sum(own.values()) / m, 1 - sum(q.values())
            kl += rest * math.log(rest / max(rest_q, 1e-12)) if rest > 1e-12 else 0
            if kl >= suffix_tree.MIN_DIVERGENCE and kl * m >= suffix_tree.MIN_GAIN:
                p = {w: (x, (x - suffix_tree.DISCOUNT) / m) for w, x in own.items()}
                factor = (1 - sum(y for _, y in p.values())) / max(1 - sum(parent[w][1] for w in own), 1e-9)
                tree[ctx] = p, m, factor
                found.append(ctx)
        level = set(found)

    def probability(s, i, depth):
        """After the longest retained suffix of at most ``depth`` words."""
        ctx = tuple(s[i - depth:i])
        if not depth:
            return root(s[i])
        if ctx not in tree:
            return probability(s, i, depth - 1)
        edges, _, factor = tree[ctx]
        return edges[s[i]][1] if s[i] in edges else factor * probability(s, i, depth - 1)
    base = lambda s: sum(math.log10((c[w] + 1) / (n + v + 1)) for w in s)
    score = lambda s: sum(math.log10(probability(s, i, min(i, suffix_tree.MAX_DEPTH))) for i in range(len(s)))
    return [(len(s), sum(c[w] > 0 for w in s), n, base(s), score(s)) for s in seqs], set(tree)


def held_to_brute_tree(spark, out):
    held = [zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in out]
    want, kept = brute_tree([r[1] for r in out], held)
    key = lambda r: (r[0], r[1])
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.held_out, r.base_score, r.score)
                  for r in suffix_tree.op7_query(frame(spark, out)).collect()), key=key)
    want = sorted(((o[0], *w[:3], h, *w[3:]) for o, w, h in zip(out, want, held)), key=key)
    assert [r[:5] for r in got] == [w[:5] for w in want]
    for r, w in zip(got, want):
        assert r[5:] == pytest.approx(w[5:], rel=1e-9)
    return kept


def test_suffix_tree_matches_dictionaries(spark, monkeypatch):
    monkeypatch.setattr(suffix_tree, "BLOCK_TOKENS", 500)
    monkeypatch.setattr(suffix_tree, "GROUP_TOKENS", 5_000)
    rng = np.random.default_rng(2)
    out = []
    for i in range(150):
        w = []
        for _ in range(40):  # a small grammar with two-word contexts
            w += [["a", "b", "c"], ["a", "d", "e"], ["x", "b", "f"], ["y", "d", f"z{rng.integers(50)}"]][rng.integers(4)]
        out.append((i, " ".join(w), "en", "s"))
    out += [(150, None, "en", "s"), (151, "", "en", "s"), (152, "never seen", "en", "s"), (153, "A B c " * 3000, "en", "s"), (153, "A b", "en", "s")]
    assert len(held_to_brute_tree(spark, out)) > 5
    assert suffix_tree.op7_query(frame(spark, out).limit(0)).count() == 0
    untrained = suffix_tree.op7_query(frame(spark, [(i, "a b", "en", "s") for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]))
    assert all((r.score, r.base_score, r.train_tokens) == (0.0, 0.0, 0) for r in untrained.collect())


def test_suffix_tree_learns_contexts_of_four_words(spark, monkeypatch):
    """Each phrase's last word is told apart a little by every word of the four before it."""
    monkeypatch.setattr(suffix_tree, "BLOCK_TOKENS", 3000)
    monkeypatch.setattr(suffix_tree, "GROUP_TOKENS", 5_000)
    rng = np.random.default_rng(5)
    out = []
    for i in range(120):
        w = []
        for _ in range(40):
            four = [f"{p}{rng.integers(2)}" for p in "abcd"]
            ones = sum(x[1] == "1" for x in four)
            w += [*four, f"r{ones}", f"n{rng.integers(300)}"]
        out.append((i, " ".join(w), "en", "s"))
    kept = held_to_brute_tree(spark, out)
    assert max(map(len, kept)) >= 4
    monkeypatch.setattr(suffix_tree, "MAX_DEPTH", 2)
    assert max(map(len, held_to_brute_tree(spark, out))) == 2


def test_suffix_tree_deals_frequent_contexts_to_many_groups(spark, monkeypatch):
    """A passage whose contexts of any length have more windows than a group holds."""
    monkeypatch.setattr(suffix_tree, "GROUP_TOKENS", 600)
    made = []
    contexts = suffix_tree.frequent_contexts
    monkeypatch.setattr(suffix_tree, "frequent_contexts", lambda *a: made.append(contexts(*a)) or made[-1])
    rng = np.random.default_rng(7)
    out = []
    for i in range(400):
        w = []
        for _ in range(4):
            w += "in the old house by the sea we met".split()
            w += [f"{a}{rng.integers(2)}" for a in "pq"] + [f"n{rng.integers(40)}", f"u{rng.integers(4000)}"]
        out.append((i, " ".join(w), "en", "s"))
    out += [(400, "the old house", "en", "s"), (401, "met in the", "en", "s")]
    assert len(held_to_brute_tree(spark, out)) > 5
    frequent = made[0]
    assert max(map(len, frequent.paths)) == suffix_tree.MAX_DEPTH
    # the passage's windows, all alike for six words, lie in several groups
    path = next(p for p in frequent.paths if len(p) == suffix_tree.MAX_DEPTH)
    before = np.repeat(np.array(path, np.int32)[:, None], 5000, axis=1)
    sizes = np.bincount(frequent.group(before, *frequent.longest(before, 5000)))
    assert (sizes > 0).sum() > 3 and sizes.max() < 2500


# ------------------------------------------------------------------ 8
def test_packing_round_trip(spark, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    special = [(200, "a<|endoftext|>B, don't!! <|ENDOFTEXT|> x's,", "en", "s"), (201, "É e\u0301 ΑΣ Σ, ½ \u00a0 q\u2028r", "en", "s")]
    docs = frame(spark, rows + special)
    pieces = packing.pack(docs, window=64)
    got = pieces.collect()
    by_doc = defaultdict(list)
    for p in got:
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length and p.offset + p.length <= 64
        by_doc[p.doc_id].append(p)
    expected = Counter((d, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()) for d, t, *_ in rows + special)
    have = Counter()
    for d, ps in by_doc.items():
        parts = sorted(ps, key=lambda p: (p.sequence_id, p.offset))
        at = b""
        for p in parts:
            assert p.start * 4 == len(at)
            at += bytes(p.ids)
            if len(at) == 4 * p.doc_tokens:
                have[(d, at)] += 1
                at = b""
    assert have == expected
    filled = Counter()
    for p in got:
        filled[p.sequence_id] += p.length
    assert sorted(filled) == list(range(len(filled))) and sum(n < 64 for n in filled.values()) <= 1
    whole = packing.sequences(pieces, window=64).collect()
    assert all(len(s.ids) in (4 * 64, 4 * s.used) and (len(s.ids) == 256 or s.used & (s.used - 1) == 0) for s in whole)
    assert packing.pack(docs.limit(0)).count() == 0


def test_packing_ids_of_any_chunk():
    """Chunks cut into units here have the ids that the whole tokenizer gives; only the others go through it."""
    import public_tokenizers
    import pyarrow as pa

    ids = packing._Ids(public_tokenizers.path(packing.VOCABULARY))
    whole, seen = ids.tokenizer, []

    class Watched:
        def encode_batch_fast(self, texts, **kw):
            seen.extend(texts)
            return whole.encode_batch_fast(texts, **kw)
    ids.tokenizer = Watched()
    ids.learn({b"words", b"Rated%%%", b"don't", "Été,élan".encode(), "Maß".encode(), b"x-9_y"})
    assert not seen
    rng = np.random.default_rng(8)
    letters = np.array(list("abcXYZ'stremvld019.,!?$%<|>-_\"()[]{}~`^&*#@/\\:;=+ÀÉÖØÞßàéöøÿ×÷½«ªºİ\u0301Σµ\u00a0\u0178 \t\n\x0b\x1c\x85\x00\x7f"))
    texts = ["".join(rng.choice(letters, rng.integers(0, 40))) for _ in range(3000)]
    texts += [None, "", "  a ", "<|endoftext|>X", "a<|STARTOFTEXT|>b'S X", "I'LL we'Ve ''s s't're 'sun", "İSTANBUL ΑΣ Σ", "X" * 500]
    at, raw = ids.encode(pa.array(texts))
    expected = [np.array(e.ids, "<u4").tobytes() for e in whole.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [bytes(raw[a:b]) for a, b in zip(at, at[1:])] == expected
    assert seen
    assert len(ids.encode(pa.array([], pa.string()))[0]) == 1
    part = pa.array([*texts, "é b", "c"]).slice(len(texts))
    assert [bytes(raw[a:b]) for at, raw in [ids.encode(part)] for a, b in zip(at, at[1:])] == [
        np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in ("é b", "c")]


def test_packing_slices_hold_all_rows(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(packing, "SLICE_BYTES", 10)
    for texts in ([], [None], ["a" * 35, None, "", "b", "c" * 9, "d"], ["", ""]):
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
        assert [t for part in packing._by_bytes(batch) for t in part.column("text").to_pylist()] == texts


# ------------------------------------------------------------------ 9
def test_word_piece_counts(spark, rows):
    path = wordpiece.default_vocabulary()
    begin, inner = map(set, wordpiece.read_vocabulary(path))
    longest = max(map(len, begin | inner))

    def greedy(word):
        at, n = 0, 0
        while at < len(word):
            end = next((e for e in range(min(len(word), at + longest), at, -1) if word[at:e] in (inner if at else begin)), None)
            if end is None:
                return 0
            at, n = end, n + 1
        return n
    got = wordpiece.op9_query(frame(spark, rows).drop("n_tokens")).collect()
    want = Counter()
    for d, t, *_ in rows:
        counts = [greedy(w) for w in (t or "").encode().split()]
        want[(d, len(counts), sum(counts) + counts.count(0), counts.count(0))] += 1
    assert Counter(map(tuple, got)) == want
    assert wordpiece.op9_query(frame(spark, []).drop("n_tokens")).count() == 0


def test_automaton_failure_links():
    automaton = wordpiece.Automaton([b"a", b"abcdx", b"b"], [b"b", b"c", b"cdy", b"dz", b"d"])
    assert [automaton.pieces(w) for w in (b"abcdx", b"abcdy", b"abcdz", b"abcd", b"abcdq", b"q", b"b")] == [1, 3, 4, 4, 0, 0, 1]


# ------------------------------------------------------------------ 10
def test_cap_filters(spark, monkeypatch):
    monkeypatch.setattr(capdedup, "BLOCK", 8)
    rng = np.random.default_rng(4)
    x = rng.standard_normal((120, 32))
    x[20:60] = x[0] + 0.12 * rng.standard_normal((40, 32))
    x[60:64] = x[1]
    x[64] = -x[2]
    data = [(i, v.tolist(), int(i % 2) if i > 60 else 0, i) for i, v in enumerate(x)]
    bad = [(200, None, 0), (201, [0.0] * 32, 0), (202, [float("nan")] * 32, 0), (203, [1.0, None], 0), (204, [], 0), (205, x[0].tolist(), None),
           (206, [1e300] * 32, 0), (None, x[0].tolist(), 0), (207, x[0][:5].tolist(), 0)]
    df = spark.createDataFrame(data + [(*b, 1) for b in bad], "vec_id long, embedding array<double>, label int, weight int")
    got = {r.vec_id: r for r in capdedup.op10_query(df).collect()}
    assert len(got) == len(data) + len(bad)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([d[2] for d in data])
    link = (unit @ unit.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(link, False)
    comp = np.arange(120)
    for _ in range(120):
        comp = np.minimum(comp, np.where(link, comp[None, :], 999).min(1))
    for i in range(120):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (link[i].sum(), comp[i], comp[i] == i)
    for i, *_ in bad:
        assert got[i].n_links == 0 and got[i].component_id == i and got[i].kept
    assert capdedup.op10_query(df.limit(0)).count() == 0


@pytest.mark.parametrize("dim", [1, 3, 8, 64])
def test_cap_filters_meet_at_the_threshold(dim):
    rng = np.random.default_rng(dim)
    u, r = rng.standard_normal((2, 1000, dim))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    r -= (r * u).sum(1, keepdims=True) * u
    w = u if dim == 1 else 0.98 * u + (1 - 0.98 ** 2) ** 0.5 * r / np.linalg.norm(r, axis=1, keepdims=True)
    met = np.zeros(1000, bool)
    for seed in range(capdedup.CODES):
        code = capdedup.ProductCode(dim, 1000, seed)
        met |= (code.decode(u)[:, :, None] == code.decode(w)[:, None, :]).any((1, 2))
    assert met.mean() > 0.998
