"""X4, X5, K7 on the long table: response spans, masks and trained share.

A conversation's rendering (X1) is the row of its messages' pieces, and no
marker crosses the border of two pieces. So each message finds the markers of
its own piece; what it must know of the messages before it are three numbers
that ``running`` carries along: the place where its piece starts, the response
markers so far, and the kind of the last marker. No conversation is gathered
for spans and shares, however long it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions import templates as tpl
from colloquy.functions.text import strip
from colloquy.operators.chat import _validity_aggs
from colloquy.operators.running import PID, lay_out, running
from colloquy.operators.skew import lookup_join

_ORDER = ["_at", "_role", "_hash"]


def _parts(piece: Column, instruction_part: str, response_part: str) -> Column:
    """Stretches of a piece, cut before every marker, with the marker's kind."""
    marker = f"(?={tpl.java_quote(instruction_part)}|{tpl.java_quote(response_part)})"
    kind = lambda p: (F.when(F.startswith(p, F.lit(response_part)), "R")
                      .when(F.startswith(p, F.lit(instruction_part)), "I").otherwise("-"))
    return F.transform(F.split(piece, marker), lambda p: F.struct(kind(p).alias("kind"), p.alias("part")))


def rendered_pieces(long: DataFrame, conv: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text",
                    instruction_part: str = tpl.GEMMA_INSTRUCTION_PART,
                    response_part: str = tpl.GEMMA_RESPONSE_PART) -> DataFrame:
    """One row per message of a valid conversation: conv, pos (0-based), piece,
    start (characters before it), parts (struct kind, part), n_responses
    (response markers before it), inside (the last marker before it was a
    response marker).

    Messages of one turn are ordered by role and hash of the text. Neither marker may
    occur inside the other."""
    rows = long.select(conv, F.col(order).alias("_at"), F.coalesce(role, F.lit("")).alias("_role"),
                       F.coalesce(text, F.lit("")).alias("_text"), F.xxhash64(text).alias("_hash"), F.col(role).isNull().alias("_none"), F.lit(1).cast("long").alias("_one"))
    laid = running(lay_out(rows, conv, _ORDER), conv, _ORDER, sums={"_one": "pos"}, lasts={"_role": "_before"})
    lead = (F.col("pos") == 0) & (F.col("_role") == "system")
    after_lead = (F.col("pos") == 1) & (F.col("_before") == "system")
    body = F.concat(strip(F.col("_text")), F.lit(tpl.GEMMA_END))
    # a leading system text opens the turn of the message behind it, a user in a valid conversation
    piece = (F.when(lead, F.concat(F.lit(tpl.GEMMA_START + "user\n"), F.col("_text"), F.lit("\n\n"))).when(after_lead, body)
             .otherwise(F.concat(F.lit(tpl.GEMMA_START), F.when(F.col("_role") == "assistant", "model").otherwise(F.col("_role")), F.lit("\n"), body)))
    aggs, valid = _validity_aggs("pos", "_r")
    told = (laid.withColumn("_r", F.when(~F.col("_none"), F.col("_role"))).groupBy(conv)
            .agg(*aggs, F.count(F.lit(1)).alias("_n")).select(conv, valid.alias("_valid"), F.col("_n").alias("n_messages"), F.col("_n").alias("_weight")))
    met = lookup_join(laid, told, [conv], "_weight", F.col("pos")).where("_valid")
    alone = lead & (F.col("n_messages") == 1)  # nothing to fold the system text into
    parts = met.withColumn("piece", F.when(alone, "").otherwise(piece)).withColumn("parts", _parts(F.col("piece"), instruction_part, response_part))
    kinds = F.filter("parts", lambda p: p["kind"] != "-")
    counted = parts.select(conv, *_ORDER, PID, "pos", "piece", "parts", F.length("piece").cast("long").alias("_size"),
                           F.size(F.filter("parts", lambda p: p["kind"] == "R")).cast("long").alias("_responses"),
                           F.try_element_at(kinds, F.lit(-1))["kind"].alias("_kind"))
    placed = running(counted, conv, _ORDER, sums={"_size": "start", "_responses": "n_responses"}, lasts={"_kind": "_last"})
    return placed.select(conv, "pos", "piece", "start", "parts", "n_responses", F.coalesce(F.col("_last") == "R", F.lit(False)).alias("inside"))


def _continued() -> Column:
    """The stretch before a piece's first marker belongs to an open span."""
    return F.col("inside") & (F.col("parts")[0]["kind"] == "-") & (F.col("parts")[0]["part"] != "")


def span_table(pieces: DataFrame, conv: str = "conv_id", response_part: str = tpl.GEMMA_RESPONSE_PART) -> DataFrame:
    """(conv, span_idx, start, span). ``start`` is the place of the span in
    the rendered text. A span that goes on over several messages is put
    together from them, which is all that is ever gathered."""
    marker = len(response_part)
    own = pieces.select(conv, "pos", "start", "n_responses", F.posexplode(F.filter(
        F.transform("parts", lambda p, i: F.struct(p["kind"].alias("kind"), p["part"].alias("part"), i.alias("i"))),
        lambda p: p["kind"] == "R")).alias("_k", "_p"), "parts")
    at = F.aggregate(F.slice("parts", 1, F.col("_p.i")), F.lit(0), lambda n, p: n + F.length(p["part"]))
    own = own.select(conv, (F.col("n_responses") + F.col("_k")).alias("span_idx"), "pos", (F.col("start") + at + marker).alias("start"),
                     F.substring(F.col("_p.part"), marker + 1, 1 << 30).alias("span"))
    more = pieces.where(_continued()).select(conv, (F.col("n_responses") - 1).alias("span_idx"), "pos", "start", F.col("parts")[0]["part"].alias("span"))
    stretch = F.struct("pos", "start", "span")
    return (own.unionAll(more).groupBy(conv, "span_idx").agg(F.sort_array(F.collect_list(stretch)).alias("_s"))  # of one span
            .select(conv, "span_idx", F.col("_s")[0]["start"].alias("start"), F.array_join(F.col("_s.span"), "").alias("span")))


def masked_pieces(pieces: DataFrame, response_part: str = tpl.GEMMA_RESPONSE_PART, fill: str = " ") -> DataFrame:
    """X5 by message: ``pieces`` and masked, its piece with every untrained
    character replaced by ``fill``."""
    blank = lambda s: F.repeat(F.lit(fill), F.length(s))
    marker = len(response_part)
    shown = F.transform("parts", lambda p, i: F.when(
        p["kind"] == "R", F.concat(F.lit(fill * marker), F.substring(p["part"], marker + 1, 1 << 30)))
        .when((p["kind"] == "-") & (i == 0) & F.col("inside"), p["part"]).otherwise(blank(p["part"])))
    return pieces.withColumn("masked", F.array_join(shown, ""))


def masked_texts(pieces: DataFrame, conv: str = "conv_id", response_part: str = tpl.GEMMA_RESPONSE_PART) -> DataFrame:
    """(conv, masked), the masked pieces of a conversation in one text.
    Here the row itself is as long as its conversation."""
    rows = masked_pieces(pieces, response_part).select(conv, F.struct("pos", "masked").alias("_m"))
    return rows.groupBy(conv).agg(F.array_join(F.sort_array(F.collect_list("_m"))["masked"], "").alias("masked"))


def trained_shares(pieces: DataFrame, conv: str = "conv_id", response_part: str = tpl.GEMMA_RESPONSE_PART) -> DataFrame:
    """K7: (conv, total_chars, trained_chars, trained_share), as sums over messages."""
    own = F.aggregate(F.filter("parts", lambda p: p["kind"] == "R"), F.lit(0).cast("long"),
                      lambda n, p: n + F.length(p["part"]) - len(response_part))
    more = F.when(_continued(), F.length(F.col("parts")[0]["part"])).otherwise(0)
    return (pieces.groupBy(conv).agg(F.sum(F.length("piece")).alias("total_chars"), F.sum(own + more).alias("trained_chars"))
            .withColumn("trained_share", F.try_divide(F.col("trained_chars"), F.col("total_chars"))))
