"""Spans, masks and shares from the long table against the rendered text."""

import random

import pytest
from pyspark.sql import functions as F

from colloquy.functions import templates as tpl
from colloquy.operators import masks
from colloquy.operators.running import lay_out, running

START, END = "<start_of_turn>", "<end_of_turn>\n"
LONG = "conv_id long, turn long, role string, text string"


def rendered(messages):
    """X1 in plain Python; None when the roles do not fit."""
    lead = bool(messages) and messages[0][0] == "system"
    loop = messages[lead:]
    if any((r == "user") != (i % 2 == 0) for i, (r, _) in enumerate(loop)):
        return None
    out = ""
    for i, (r, t) in enumerate(loop):
        prefix = (messages[0][1] or "") + "\n\n" if lead and i == 0 else ""
        out += f"{START}{'model' if r == 'assistant' else r or ''}\n{prefix}{(t or '').strip()}{END}"
    return out


def plain_spans(text):
    out, at = [], 0
    for k, part in enumerate(text.split(tpl.GEMMA_RESPONSE_PART)):
        if k:
            out.append((at, part.split(tpl.GEMMA_INSTRUCTION_PART)[0]))
        at += len(part) + len(tpl.GEMMA_RESPONSE_PART)
    return out


@pytest.fixture(scope="module")
def chats():
    rng = random.Random(1)
    bits = ["word", " ", "\n", "é𝒳", "<start_of_turn>", "<start_of_turn>model\n", "<start_of_turn>user\n", "model\n", "<end_of_turn>\n", ""]
    text = lambda: "".join(rng.choices(bits, k=rng.randrange(0, 6)))
    out = {}
    for conv in range(250):
        roles = ["system"] if rng.random() < .4 else []
        for i in range(rng.randrange(0, 7)):
            roles.append("user" if i % 2 == 0 else rng.choice(["assistant", "assistant", "tool", None, "system"]))
        if rng.random() < .15 and roles:
            roles[rng.randrange(len(roles))] = rng.choice(["user", "assistant", None])
        if roles:
            out[conv] = [(r, rng.choice([text(), text(), None])) for r in roles]
    out[500] = [(("user", "assistant")[i % 2], f"turn {i} " + text()) for i in range(900)]  # spans partitions
    out[501] = [("user", "x"), ("assistant", "long " * 20_000), ("user", ""), ("tool", "goes on")]
    return out


@pytest.fixture(scope="module")
def pieces(spark, chats):
    rows = [(c, 3 * i - 2, r, t) for c, m in chats.items() for i, (r, t) in enumerate(m)]
    random.Random(2).shuffle(rows)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = masks.rendered_pieces(spark.createDataFrame(rows, LONG)).cache()
    got.count()
    spark.conf.set("spark.sql.shuffle.partitions", old)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    return got


def texts(chats):
    return {c: t for c, t in ((c, rendered(m)) for c, m in chats.items()) if t is not None}


def test_pieces_are_the_rendering(pieces, chats):
    rows = pieces.orderBy("conv_id", "pos").collect()
    got = {}
    for r in rows:
        assert r.start == len(got.get(r.conv_id, ""))
        got[r.conv_id] = got.get(r.conv_id, "") + r.piece
    assert got == texts(chats)


def test_spans(pieces, chats):
    got = {(r.conv_id, r.span_idx): (r.start, r.span) for r in masks.span_table(pieces).collect()}
    assert got == {(c, k): s for c, t in texts(chats).items() for k, s in enumerate(plain_spans(t))}


def test_masks_and_shares(pieces, chats):
    want_mask, want_share = {}, {}
    for c, t in texts(chats).items():
        shown = [" "] * len(t)
        spans = plain_spans(t)
        for at, s in spans:
            shown[at:at + len(s)] = s
        want_mask[c], n = "".join(shown), sum(len(s) for _, s in spans)
        want_share[c] = (len(t), n, n / len(t) if t else None)
    assert {r.conv_id: r.masked for r in masks.masked_texts(pieces).collect()} == want_mask
    assert {r.conv_id: tuple(r)[1:] for r in masks.trained_shares(pieces).collect()} == want_share


def test_equals_the_nested_form(spark, pieces, chats):
    df = spark.createDataFrame([(c, t) for c, t in texts(chats).items()], "conv_id long, text string")
    nested = {r.conv_id: (r.m, r.n, list(r.s)) for r in df.select(
        "conv_id", tpl.masked_text("text").alias("m"), tpl.trained_chars("text").alias("n"), tpl.response_spans("text").alias("s")).collect()}
    spans = {}
    for r in masks.span_table(pieces).orderBy("conv_id", "span_idx").collect():
        spans.setdefault(r.conv_id, []).append(r.span)
    masked = {r.conv_id: r.masked for r in masks.masked_texts(pieces).collect()}
    shares = {r.conv_id: r.trained_chars for r in masks.trained_shares(pieces).collect()}
    assert nested == {c: (masked[c], shares[c], spans.get(c, [])) for c in masked}


def test_no_conversation_is_gathered_for_spans_and_shares(spark):
    long = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b")], LONG)
    plan = masks.trained_shares(masks.rendered_pieces(long))._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_" not in plan
    assert masks.rendered_pieces(long.limit(0)).count() == 0


def test_running_values_over_partitions(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, 1, 1, 1, 2, 3]), i, rng.randrange(5), rng.choice([None, None, f"v{i}"])) for i in range(600)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    laid = lay_out(spark.createDataFrame(rows, "g long, i long, n long, v string").repartition(7), "g", ["i"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = {r.i: (r.s, r.l) for r in running(laid, "g", ["i"], sums={"n": "s"}, lasts={"v": "l"}).collect()}
    state, want = {}, {}
    for g, i, n, v in rows:
        s, last = state.get(g, (0, None))
        want[i] = (s, last)
        state[g] = (s + n, v or last)
    assert got == want and laid.select(F.countDistinct("_pid")).first()[0] > 1
