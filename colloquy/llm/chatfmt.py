"""Chat formatting in budgeted windows (operator 5).

Turns are range-sorted by (conversation, turn). One streaming pass over each
sorted partition writes every turn, rendered and escaped, with the running
sum of its conversation's turn tokens inside the partition; the totals of
conversations that cross partition borders (one row per partition) make those
sums global. A conversation of any length therefore spreads over partitions.

Windows: turn t belongs to window floor(S / SPAN), S being the tokens of the
turns before it without the leading system turn. A window repeats the leading
system turn, then the turns of the window before that begin within HISTORY
tokens of its edge; the loss mask covers the texts of its own assistant
turns, so repeated targets are masked and each is trained on once. A window
holds fewer than SPAN + HISTORY tokens besides the system turn and the two
turns that cross its edges; turns are never cut.

Template: ``<s>[ROLE] role [/ROLE] text </s>``. A control string inside a
role or text gets one more backslash in front of the backslashes before it;
reading takes that one away, so the way back is exact. Offsets count code
points.

Defined results: a null role or text is the empty string; null turns come
first, equal turns are ordered by role and text; repeated rows are turns of
their own; a null conversation id is a conversation like any other; an empty
table gives no windows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colloquy.llm.common import slices, stored

SPAN, HISTORY = 512, 128
MARK_TOKENS = 4
TARGET_ROLE, LEAD_ROLE = "assistant", "system"

_CONTROL = r"(?:</?s>|\[/?(?:ROLE|INST)\])"
_PLAIN = re.compile(r"(?<!\\)\\*" + _CONTROL)
_ESCAPED = re.compile(r"(?<!\\)\\(\\*" + _CONTROL + ")")
_TURN = re.compile(r"(?<!\\)<s>(?<!\\)\[ROLE\] (.*?) (?<!\\)\[/ROLE\] (.*?) (?<!\\)</s>", re.S)


def escape(text: str) -> str:
    return _PLAIN.sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """(turn, begin and length of the escaped text in it)."""
    head, body = f"<s>[ROLE] {escape(role)} [/ROLE] ", escape(text)
    return f"{head}{body} </s>", len(head), len(body)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a window."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


_TURNS = ("part int, n long, conv_id long, head boolean, idx long, before long, lead long, tokens long, "
          "role string, turn string, begin int, size int")


def _rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, n = TaskContext.get().partitionId(), 0
    first, conv, idx, before, lead = True, None, 0, 0, 0
    head = True
    for batch in batches:
        for some in slices(batch):
            out = []
            for c, role, text in zip(*(some.column(k).to_pylist() for k in ("conv_id", "role", "text"))):
                if first or c != conv:
                    head = first
                    first, conv, idx, before, lead = False, c, 0, 0, 0
                tokens = len(text.split()) + MARK_TOKENS
                if idx == 0 and role == LEAD_ROLE:
                    lead = tokens
                out.append((part, n, c, head, idx, before, lead, tokens, role, *render(role, text)))
                n, idx, before = n + 1, idx + 1, before + tokens
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out), (
                pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(),
                pa.string(), pa.string(), pa.int32(), pa.int32()))], names=[f.split()[0] for f in _TURNS.split(", ")])


def _placed(turns: DataFrame) -> DataFrame:
    """Global turn number and prefix sum for turns whose conversation began in
    an earlier partition: running sums over two rows per partition, one for
    its first and one for its last conversation."""
    none = F.lit(0).cast("long")
    heads = turns.where("head").groupBy("part").agg(F.first("conv_id").alias("conv_id")).select(
        "part", "conv_id", F.lit(False).alias("is_tail"), none.alias("turns"), none.alias("sum"), F.lit(None).cast("long").alias("lead"))
    tails = turns.groupBy("part").agg(F.max_by(F.struct("conv_id", (F.col("idx") + 1).alias("turns"),
                                                        (F.col("before") + F.col("tokens")).alias("sum"), "lead"), "n").alias("t"))
    tails = tails.select("part", "t.conv_id", F.lit(True).alias("is_tail"), "t.turns", "t.sum", "t.lead")
    so_far = Window.partitionBy("conv_id").orderBy("part", "is_tail").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (heads.unionByName(tails)
               .select("part", "is_tail", F.sum("turns").over(so_far).alias("_turns"), F.sum("sum").over(so_far).alias("_sum"),
                       F.first("lead", ignorenulls=True).over(so_far).alias("_first_lead"))
               .where("not is_tail and _first_lead is not null").drop("is_tail"))
    joined = turns.join(F.broadcast(earlier.withColumn("head", F.lit(True))), ["part", "head"], "left")
    return (joined.withColumn("lead", F.coalesce("_first_lead", "lead"))
            .withColumn("idx", F.col("idx") + F.coalesce("_turns", F.lit(0)))
            .withColumn("before", F.col("before") + F.coalesce("_sum", F.lit(0)))
            .drop("_first_lead", "_turns", "_sum", "part", "n", "head"))


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    mask = pa.list_(pa.struct([("begin", pa.int64()), ("size", pa.int64())]))
    for batch in batches:
        for some in slices(batch, 64):
            texts, masks, repeated, first = [], [], [], []
            for lead, items in zip(some.column("lead_turn").to_pylist(), some.column("items").to_pylist()):
                items.sort(key=lambda x: x["idx"])
                own = next(x["idx"] for x in items if x["own"])
                parts = [] if lead is None or items[0]["idx"] == 0 else [lead]
                at, spans = sum(map(len, parts)), []
                again = len(parts) + sum(not x["own"] for x in items)
                for x in items:
                    if x["own"] and x["role"] == TARGET_ROLE:
                        spans.append({"begin": at + x["begin"], "size": x["size"]})
                    parts.append(x["turn"])
                    at += len(x["turn"])
                texts.append("".join(parts))
                masks.append(spans)
                repeated.append(again)
                first.append(own)
            yield pa.RecordBatch.from_arrays(
                [some.column("conv_id"), some.column("window"), pa.array(texts, pa.string()), pa.array(masks, mask),
                 pa.array(repeated, pa.int32()), pa.array(first, pa.int64())],
                names=["conv_id", "window", "formatted", "loss", "n_repeated", "first_turn"])


def format_chats(conversations: DataFrame) -> DataFrame:
    """One row per window: conv_id, window, formatted, loss (begin and size of
    the spans trained on), n_repeated (leading turns that are repeats),
    first_turn (number of its first own turn)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role"), text("text"))
    order = ["conv_id", "turn", "role", "text"]
    turns = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_rendered, _TURNS), "chat-turns")
    placed = _placed(turns)
    start = F.when(F.col("idx") == 0, 0).otherwise(F.col("before") - F.col("lead"))
    own = F.floor(start / SPAN).cast("long")
    is_lead = (F.col("idx") == 0) & (F.col("role") == LEAD_ROLE)
    near_edge = ~is_lead & (start % SPAN >= SPAN - HISTORY)
    windows = F.when(near_edge, F.array(own, own + 1)).otherwise(F.array(own))
    item = F.struct("idx", F.col("_own").alias("own"), "role", "turn", "begin", "size")
    grouped = (placed.withColumn("_home", own).withColumn("window", F.explode(windows)).withColumn("_own", F.col("window") == F.col("_home"))
               .groupBy("conv_id", "window").agg(F.collect_list(item).alias("items"), F.max("_own").alias("_any"))  # one window
               .where("_any").drop("_any"))
    leads = placed.where(is_lead).select(F.col("conv_id").alias("_c"), F.col("turn").alias("lead_turn"))
    full = grouped.join(leads, F.col("conv_id").eqNullSafe(F.col("_c")), "left").drop("_c")
    return full.mapInArrow(_assembled, "conv_id long, window long, formatted string, loss array<struct<begin:bigint,size:bigint>>, "
                                       "n_repeated int, first_turn long")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation, over windows that arrive in order; a hash is a
    sequential reduction, its state is all that is held."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    state, conv = None, None

    def row():
        n, turns, chars, loss, size = state
        return conv, n, turns.hexdigest(), chars, loss.hexdigest(), size

    for batch in batches:
        for some in slices(batch):
            out = []
            for c, formatted, spans, again in zip(*(some.column(k).to_pylist() for k in ("conv_id", "formatted", "loss", "n_repeated"))):
                if state is None or c != conv:
                    if state is not None:
                        out.append(row())
                    state, conv = [0, hashlib.sha256(), 0, hashlib.sha256(), 0], c
                for role, text in read_turns(formatted)[again:]:
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                for span in spans:
                    text = unescape(formatted[span["begin"]:span["begin"] + span["size"]])
                    state[2] += len(text)
                    state[3].update(text.encode("utf-8", "surrogatepass"))
                state[4] += len(formatted)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out), kinds)], names=names)
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row(), kinds)], names=names)


def read_back(windows: DataFrame) -> DataFrame:
    """Digests of each conversation, read back from its windows."""
    dealt = windows.select("conv_id", "window", "formatted", "loss", "n_repeated")
    return dealt.repartition("conv_id").sortWithinPartitions("conv_id", "window").mapInArrow(
        _digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op5_query(conversations: DataFrame) -> DataFrame:
    spark = conversations.sparkSession
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return read_back(format_chats(rows.unionByName(extra)))
