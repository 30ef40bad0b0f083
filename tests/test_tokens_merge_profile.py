"""K1-K6, A18, A17, A1-A7, T1-T3, N9, dense_index: against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquy.operators import merge, profile, tokens
from colloquy.operators.indexing import dense_index

TEXTS = ["the cat sat on the mat.", "The dog; the cat!", "über straße 42 x42", ""]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")


def test_tokenize_and_vocab(spark, docs):
    toks = tokens.token_rows(docs)
    rows = toks.collect()
    assert [r["token"] for r in sorted(rows, key=lambda r: (r["doc_id"], r["pos"])) if r["doc_id"] == 1] == \
        ["The", "dog", ";", "the", "cat", "!"]
    vocab = {r["token"]: (r["token_id"], r["n"]) for r in tokens.build_vocab(toks).collect()}
    cnt = Counter(r["token"] for r in rows)
    want = sorted(cnt.items(), key=lambda kv: (-kv[1], kv[0].encode()))
    assert [vocab[t][0] for t, _ in want] == list(range(len(want)))
    top = tokens.vocab_top(toks, 2).collect()
    assert [(r["token_id"], r["token"]) for r in top] == [(0, want[0][0]), (1, want[1][0])]
    counts = {r["doc_id"]: r["n_tokens"] for r in tokens.token_counts(docs).collect()}
    assert counts == {0: 7, 1: 6, 2: 4, 3: 0}


def test_encode_decode_roundtrip(spark, docs):
    toks = tokens.token_rows(docs)
    vocab = tokens.build_vocab(toks.where("doc_id <> 2"))
    chk = {r["doc_id"]: r for r in tokens.roundtrip_check(toks, vocab).collect()}
    assert chk[0]["roundtrip_ok"] and chk[0]["n_unknown"] == 0
    assert not chk[2]["roundtrip_ok"] and chk[2]["n_unknown"] == 4
    listing = tokens.list_tokens(toks, vocab).where("doc_id = 0").orderBy("pos").collect()
    assert [r["pos"] for r in listing] == list(range(7))


def test_length_filter(spark):
    df = spark.createDataFrame([(1, ["a"] * 5), (2, ["b"] * 2)], "id int, tokens array<string>")
    out = {r["id"]: r for r in tokens.length_filter(df, 3, truncate=True).collect()}
    assert (out[1]["within_limit"], out[1]["kept_tokens"], len(out[1]["tokens"])) == (False, 3, 3)
    assert out[2]["within_limit"]


def test_pluggable_tokeniser(spark, docs):
    tok = tokens.tokenize_with(lambda: (lambda t: t.lower().split()), key="lower-split")
    got = {r["doc_id"]: r["t"] for r in docs.select("doc_id", tok("text").alias("t")).collect()}
    assert got[1] == ["the", "dog;", "the", "cat!"]


def test_merge_linear_matches_numpy(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=8).astype(np.float32), rng.normal(size=8).astype(np.float32)
    params = spark.createDataFrame([("m1", "w", 0, a.tolist()), ("m2", "w", 0, b.tolist()),
                                    ("m1", "v", 0, [1.0, 2.0]), ("m2", "v", 0, [3.0, 4.0])],
                                   "model string, tensor string, chunk int, values array<float>")
    w = merge.weights_frame(spark, [("m1", 1.0), ("m2", 3.0)])
    out = {r["tensor"]: r["values"] for r in merge.merge_linear(params, w).collect()}
    assert np.allclose(out["w"], (a.astype(float) + 3 * b.astype(float)) / 4, atol=1e-6)
    assert out["v"] == [2.5, 3.5]
    raw = {r["pos"]: r["value"] for r in merge.merge_linear_long(params, w, normalize=False).where("tensor = 'v'").collect()}
    assert raw == {0: 10.0, 1: 14.0}
    bad = params.union(spark.createDataFrame([("m1", "z", 0, [1.0])], params.schema))
    assert [r["tensor"] for r in merge.merge_rejects(bad, w).collect()] == ["z"]


@pytest.fixture(scope="module")
def convs(spark):
    rows = []
    pats = {0: ["user", "assistant"], 1: ["system", "user", "assistant"], 2: ["user", "assistant"],
            3: ["user", "assistant", "user"], 4: ["system", "user", "assistant"], 5: ["user", "assistant"]}
    for c, roles in pats.items():
        for t, r in enumerate(roles):
            rows.append((c, t, r, f"{r} text {c}-{t}" + "x" * t))
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), pats


def test_profile_brute_force(spark, convs):
    df, pats = convs
    pdf = df.toPandas()
    rd = {r["role"]: (r["n"], r["rank"]) for r in profile.role_distribution(df).collect()}
    cnt = Counter(pdf.role)
    assert {k: v[0] for k, v in rd.items()} == dict(cnt)
    assert rd["user"][1] == 1 and rd["system"][1] == 3
    ml = profile.message_length_stats(df).collect()[0]
    lens = pdf.text.str.len()
    assert (ml["avg_chars"], ml["min_chars"], ml["max_chars"]) == (lens.mean(), lens.min(), lens.max())
    cl = profile.conversation_length_stats(df).collect()[0]
    sizes = [len(v) for v in pats.values()]
    assert (cl["avg_messages"], cl["min_messages"], cl["max_messages"]) == (np.mean(sizes), 2, 3)
    hist = [(r["n_messages"], r["n_conversations"]) for r in profile.conversation_length_histogram(df, k=1).collect()]
    assert hist == [(2, 3)]
    rp = profile.role_patterns(df, k=2).orderBy("rank").collect()
    assert [(r["pattern"], r["n"]) for r in rp] == [("user -> assistant", 3), ("system -> user -> assistant", 2)]
    sr = profile.system_message_rate(df).collect()[0]
    assert (sr["with_system"], sr["total"]) == (2, 6)
    first = profile.first_n(df, 2)
    assert sorted({r[0] for r in first.select("conv_id").collect()}) == [0, 1]
    s1 = [r[0] for r in profile.sample_rows(df.select("conv_id").distinct(), 3, 7, key="conv_id").collect()]
    s2 = [r[0] for r in profile.sample_rows(df.select("conv_id").distinct(), 3, 7, key="conv_id").collect()]
    assert s1 == s2 and len(set(s1)) == 3


@pytest.mark.parametrize("chunk", [2, 3, 128])
def test_role_pattern_keys_exact(spark, chunk):
    """Equal keys exactly when role sequences are equal, across key levels."""
    import random

    rnd = random.Random(chunk)
    seqs = [[rnd.choice(["user", "assistant", "system"]) for _ in range(rnd.randint(1, 12))] for _ in range(40)]
    seqs += [list(seqs[3]), list(seqs[7]), ["user"] * 30, ["user"] * 30, ["user"] * 29 + ["assistant"]]
    rows = [(c, t, r) for c, seq in enumerate(seqs) for t, r in enumerate(seq)]
    long = spark.createDataFrame(rows, "conv_id long, turn long, role string")
    got = {r["conv_id"]: (r["n_messages"], r["_key"])
           for r in profile.role_pattern_keys(long, chunk=chunk).collect()}
    assert sorted(got) == list(range(len(seqs)))
    for a in range(len(seqs)):
        assert got[a][0] == len(seqs[a])
        for b in range(len(seqs)):
            assert (got[a] == got[b]) == (seqs[a] == seqs[b]), (a, b)


@pytest.mark.parametrize("chunk", [2, 128])
def test_role_patterns_top_k_brute_force(spark, chunk):
    """Top-k patterns, counts, percent and first-seen tie order; with a tiny
    chunk the long conversations go through several key levels."""
    import random

    rnd = random.Random(11)
    seqs = [[rnd.choice(["user", "assistant"]) for _ in range(rnd.randint(1, 4))] for _ in range(50)]
    seqs += [["system"] + ["user", "assistant"] * 6] * 4 + [["user"] * 9] * 3
    rows = [(c, t, r) for c, seq in enumerate(seqs) for t, r in enumerate(seq)]
    long = spark.createDataFrame(rows, "conv_id long, turn long, role string")
    first_seen, cnt = {}, Counter()
    for c, seq in enumerate(seqs):
        p = " -> ".join(seq)
        first_seen.setdefault(p, c)
        cnt[p] += 1
    want = sorted(cnt.items(), key=lambda kv: (-kv[1], first_seen[kv[0]]))[:6]
    got = profile.role_patterns(long, k=6, chunk=chunk).orderBy("rank").collect()
    assert [(r["pattern"], r["n"]) for r in got] == want
    assert [r["rank"] for r in got] == list(range(1, 7))
    assert abs(got[0]["pct"] - round(100.0 * want[0][1] / len(seqs), 2)) < 0.01


def test_special_tokens(spark):
    df = spark.createDataFrame([("a <bos> b <bos>",), ("<|user|>\nhi",), ("none",)], "text string")
    got = {r["marker"]: (r["occurrences"], r["rows_with_marker"]) for r in profile.special_token_counts(df).collect()}
    assert got["<bos>"] == (2, 1) and got["<|user|>"] == (1, 1) and got["<eos>"] == (0, 0)


def test_schema_profile(spark, convs):
    df, _ = convs
    (r,) = profile.profile_schema({"train": df}).collect()
    assert (r["n_rows"], r["n_columns"], r["columns"]) == (df.count(), 4, "conv_id,turn,role,text")


def test_dense_index_is_consecutive(spark):
    df = spark.range(0, 5000, numPartitions=7).withColumn("k", (F.col("id") * 7919) % 5000)
    out = dense_index(df, ["k", "id"], "i").select("k", "i").collect()
    assert sorted(r["i"] for r in out) == list(range(5000))
    assert all(r["i"] == r["k"] for r in out)


def test_dense_index_wide_shuffled_input(spark):
    """Positions equal the brute-force sort on a wide input that arrives
    through a shuffle (row order within partitions is not fixed)."""
    base = (spark.range(0, 3000, numPartitions=5)
            .withColumn("g", F.col("id") % 17)
            .withColumn("pad", F.repeat(F.lit("x"), 50)))
    wide = base.repartition(11, "g").withColumn("score", (F.col("id") * 31) % 97)
    out = dense_index(wide, [F.desc("score"), F.asc("id")], "i").select("id", "score", "i").collect()
    want = sorted(((r["score"], r["id"]) for r in out), key=lambda t: (-t[0], t[1]))
    pos = {idv: i for i, (_, idv) in enumerate(want)}
    assert sorted(r["i"] for r in out) == list(range(3000))
    assert all(r["i"] == pos[r["id"]] for r in out)


def test_slices(spark):
    from colloquy.sources.chat import parse_slice, row_at, slice_split
    df = spark.range(0, 100).withColumnRenamed("id", "k")
    assert parse_slice("train[:20000]") == (0, 20000) and parse_slice("[5:]") == (5, None)
    assert [r[0] for r in slice_split(df, "[10:13]", "k").collect()] == [10, 11, 12]
    assert sorted(r[0] for r in slice_split(df, "[97:]", "k").collect()) == [97, 98, 99]
    assert row_at(df, 42, "k").collect()[0][0] == 42


def test_rows_by_place_equal_a_sorted_list(spark, monkeypatch):
    """Histogram rounds down to single keys, with ties, nulls and two columns."""
    import random

    from colloquy.operators import select

    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 1, 1, 1, 2, 5, 7, 9]), rng.choice([None, "a", "b", "ab"]), i) for i in range(400)]
    df = spark.createDataFrame(rows, "a int, b string, id int").repartition(3)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")
    ordered = sorted(rows, key=key)
    for few, pivots, ends in ((4096, 15, ((0, 5), (3, 3), (17, 160), (200, None), (390, 1000), (400, None))), (3, 4, ((0, 400), (17, 160), (50, 51)))):
        monkeypatch.setattr(select, "FEW", few)
        monkeypatch.setattr(select, "PIVOTS", pivots)
        for start, stop in ends:
            got = [tuple(r) for r in select.rows_between(df, [F.col("a"), F.col("b")], start, stop).collect()]
            assert sorted(map(key, got)) == [key(r) for r in ordered[start:stop]] and len(set(got)) == len(got)
        total = [tuple(r) for r in select.rows_between(df, [F.col("a"), F.col("b"), F.col("id")], 17, 160).collect()]
        want = sorted(rows, key=lambda r: (*key(r), r[2]))[17:160]
        assert sorted(total, key=repr) == sorted(want, key=repr)
    assert select.rows_between(df.limit(0), [F.col("a")], 0, 5).count() == 0


def test_slices_and_first_n_beyond_one_round(spark, monkeypatch, convs):
    from colloquy.operators import select
    from colloquy.sources.chat import row_at, slice_split

    monkeypatch.setattr(select, "FEW", 2)
    df = spark.range(0, 100, numPartitions=3).withColumnRenamed("id", "k")
    got = {s: [r[0] for r in slice_split(df, s, "k").collect()] for s in ["[10:13]", "[:5]", "[95:200]"]}
    assert got == {"[10:13]": [10, 11, 12], "[:5]": [0, 1, 2, 3, 4], "[95:200]": [95, 96, 97, 98, 99]}
    assert row_at(df, 42, "k").collect()[0][0] == 42 and row_at(df, 100, "k").count() == 0
    long, _ = convs
    assert {r[0] for r in profile.first_n(long, 4).collect()} == {0, 1, 2, 3}
    keys = long.select("conv_id").distinct()
    ids = sorted(r[0] for r in keys.collect())
    want = sorted(sorted(ids, key=lambda i: hashlib.md5(f"{i}7".encode()).hexdigest())[:3])
    assert sorted(r[0] for r in profile.sample_rows(keys, 3, 7, key="conv_id").collect()) == want
    assert profile.sample_rows(keys, 3, 7).count() == 3 and profile.first_n(long, 10**6).count() == long.count()


def test_encode_decode_with_hot_and_unknown_tokens(spark):
    rows = [(i, p, t) for i in range(50) for p, t in enumerate(["the"] * 40 + ["unknown"] * 30 + [f"w{i}", f"x{i}", None])]
    toks = spark.createDataFrame(rows, "doc_id int, pos long, token string").repartition(3)
    words = ["the"] + [f"w{i}" for i in range(50)]
    vocab = spark.createDataFrame(list(enumerate(words)), "token_id long, token string")
    enc = tokens.encode(toks, vocab)
    want = {(d, p): words.index(t) if t in words else -1 for d, p, t in rows}
    assert {(r.doc_id, r.pos): r.token_id for r in enc.collect()} == want
    dec = {(r.doc_id, r.pos): r.decoded for r in tokens.decode(enc, vocab).collect()}
    assert dec == {(d, p): t if t in words else None for d, p, t in rows}
    checked = {r.doc_id: (r.n_tokens, r.id_sum, r.n_unknown, r.roundtrip_ok) for r in tokens.roundtrip_check(toks, vocab).collect()}
    assert checked == {i: (73, i + 1 - 32, 32, False) for i in range(50)}


def test_nest_unnest(spark, convs):
    from colloquy.sources.chat import nest_messages, unnest_messages
    df, pats = convs
    nested = nest_messages(df)
    got = {r["conv_id"]: [m["role"] for m in r["messages"]] for r in nested.collect()}
    assert got == pats
    back = unnest_messages(nested)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_turn_positions(spark, convs):
    from colloquy.operators.chat import turn_positions
    df, pats = convs
    flags = {(r["conv_id"], r["turn"]): (r["is_first"], r["is_last"]) for r in turn_positions(df).collect()}
    assert flags[(1, 0)] == (True, False) and flags[(1, 2)] == (False, True)


def test_gaps_and_offsets_in_turns_do_not_matter(spark):
    from colloquy.operators import chat

    rows = [(1, 0, "user"), (1, 200, "assistant"), (2, 0, "user"), (2, 1, "assistant"), (3, 5, "user"), (3, 6, "assistant")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string")
    got = profile.role_patterns(df).collect()
    assert [(r["pattern"], r["n"], r["pct"]) for r in got] == [("user -> assistant", 3, 100.0)]
    assert all(r["valid"] for r in chat.gemma_validity_long(df).collect())
    assert all(r["n_tokens"] is not None for r in chat.gemma_token_counts_long(df, r"\w+").collect())


def test_incomplete_tensors_are_rejected(spark):
    rows = [("m1", "u", 0, [1.0]), ("m1", "t", 0, [1.0, 2.0]), ("m2", "t", 0, [1.0]), ("m1", "v", 0, [1.0]), ("m2", "v", 0, [3.0])]
    df = spark.createDataFrame(rows, "model string, tensor string, chunk int, values array<float>")
    w = merge.weights_frame(spark, [("m1", 1.0), ("m2", 1.0)])
    assert [(r["tensor"], r["values"]) for r in merge.merge_linear(df, w).collect()] == [("v", [2.0])]
    assert sorted(r["tensor"] for r in merge.merge_rejects(df, w).collect()) == ["t", "u"]


def test_roundtrip_encodes_a_token_once(spark, monkeypatch):
    seen = []
    encode = tokens.encode
    monkeypatch.setattr(tokens, "encode", lambda t, *a, **k: (seen.append(t.count()), encode(t, *a, **k))[1])
    rows = spark.createDataFrame([(d, t) for d in range(50) for t in ("a", "b", "b", "c", None)] + [(None, "a")], "doc_id int, token string")
    vocab = spark.createDataFrame([(0, "b"), (7, "a")], "token_id long, token string")
    got = {r.doc_id: tuple(r)[1:] for r in tokens.roundtrip_check(rows, vocab).collect()}
    assert got == {**{d: (5, 7 + 0 + 0 - 1 - 1, 2, False) for d in range(50)}, None: (1, 7, 0, True)}
    assert seen == [4]  # not once for each of 50 rows
