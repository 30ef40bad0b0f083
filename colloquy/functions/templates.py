"""Chat templates and response masks on ``ARRAY<STRUCT<role, content>>`` columns.

X1 render_gemma, X2 render_role_tags, X4 response_spans, X5 masked_text,
K7 trained characters. Built from higher-order functions only, so a whole
conversation renders inside one JVM expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from colloquy.functions.text import strip

# Gemma 3 chat format markers.
GEMMA_START = "<start_of_turn>"
GEMMA_END = "<end_of_turn>\n"
GEMMA_BOS = "<bos>"
GEMMA_INSTRUCTION_PART = "<start_of_turn>user\n"
GEMMA_RESPONSE_PART = "<start_of_turn>model\n"

# Role-tag chat format markers.
TAG_SYSTEM = "<|system|>\n"
TAG_USER = "<|user|>\n"
TAG_ASSISTANT = "<|assistant|>\n"
DEFAULT_EOS = "<|im_end|>"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_quote(s: str) -> str:
    """``java.util.regex.Pattern.quote``: literal regex for ``split``."""
    if "\\E" not in s:
        return "\\Q" + s + "\\E"
    return "\\Q" + s.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def gemma_parts(messages) -> dict[str, Column]:
    """Pieces of the Gemma rendering: loop messages, system prefix, validity."""
    msgs = _c(messages)
    first = F.get(msgs, 0)
    has_sys = F.coalesce(first["role"] == "system", F.lit(False))
    loop = F.when(has_sys, F.slice(msgs, 2, F.greatest(F.size(msgs) - 1, F.lit(1)))).otherwise(msgs)
    prefix = F.when(has_sys, F.concat(F.coalesce(first["content"], F.lit("")), F.lit("\n\n"))).otherwise(F.lit(""))
    # user turns on even loop positions, anything else on odd ones
    valid = F.forall(
        F.transform(loop, lambda m, i: F.coalesce(m["role"] == "user", F.lit(False)) == ((i % 2) == 0)),
        lambda ok: ok,
    )
    return {"loop": loop, "prefix": prefix, "valid": valid, "has_system": has_sys}


def render_gemma(messages, add_generation_prompt: bool = False) -> Column:
    """``STRUCT<valid BOOLEAN, text STRING>``; ``text`` is NULL when invalid.

    ``<start_of_turn>ROLE\\nCONTENT<end_of_turn>\\n`` per turn, ``assistant``
    written ``model``, content trimmed, a leading system turn folded into the
    first loop turn as ``system + '\\n\\n'``; the ``<bos>`` prefix is not emitted.
    """
    p = gemma_parts(messages)
    frags = F.transform(
        p["loop"],
        lambda m, i: F.concat(
            F.lit(GEMMA_START),
            F.when(m["role"] == "assistant", F.lit("model")).otherwise(F.coalesce(m["role"], F.lit(""))),
            F.lit("\n"),
            F.when(i == 0, p["prefix"]).otherwise(F.lit("")),
            strip(F.coalesce(m["content"], F.lit(""))),
            F.lit(GEMMA_END),
        ),
    )
    text = F.array_join(frags, "")
    if add_generation_prompt:
        text = F.concat(text, F.lit(GEMMA_RESPONSE_PART))
    return F.struct(p["valid"].alias("valid"), F.when(p["valid"], text).alias("text"))


def render_role_tags(messages, eos: str = DEFAULT_EOS, add_generation_prompt: bool = False) -> Column:
    """``<|system|>`` / ``<|user|>`` / ``<|assistant|>`` blocks.

    Assistant content is followed by ``eos`` and a newline unless it is the
    last message; other roles render nothing; the generation prompt follows
    the last message only.
    """
    msgs = _c(messages)
    n = F.size(msgs)

    def frag(m, i):
        last = i == n - 1
        content = F.coalesce(m["content"], F.lit(""))
        body = (F.when(m["role"] == "system", F.concat(F.lit(TAG_SYSTEM), content, F.lit("\n")))
                .when(m["role"] == "user", F.concat(F.lit(TAG_USER), content, F.lit("\n")))
                .when(m["role"] == "assistant",
                      F.concat(F.lit(TAG_ASSISTANT), content, F.lit(eos),
                               F.when(last, F.lit("")).otherwise(F.lit("\n"))))
                .otherwise(F.lit("")))
        if add_generation_prompt:
            body = F.concat(body, F.when(last, F.lit(TAG_ASSISTANT)).otherwise(F.lit("")))
        return body

    return F.array_join(F.transform(msgs, frag), "")


def response_spans(text, instruction_part: str = GEMMA_INSTRUCTION_PART,
                   response_part: str = GEMMA_RESPONSE_PART) -> Column:
    """Trained spans: text after each response marker up to the next
    instruction marker (markers excluded, ``<end_of_turn>\\n`` kept)."""
    parts = F.split(_c(text), java_quote(response_part))
    later = F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1)))
    return F.transform(later, lambda p: F.substring_index(p, instruction_part, 1))


def masked_text(text, instruction_part: str = GEMMA_INSTRUCTION_PART,
                response_part: str = GEMMA_RESPONSE_PART, fill: str = " ") -> Column:
    """The text with every untrained character replaced by ``fill``;
    the length is unchanged."""
    parts = F.split(_c(text), java_quote(response_part))
    later = F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1)))
    head = F.repeat(F.lit(fill), F.length(F.get(parts, 0)))

    def keep(p):
        kept = F.substring_index(p, instruction_part, 1)
        return F.concat(F.lit(fill * len(response_part)), kept,
                        F.repeat(F.lit(fill), F.length(p) - F.length(kept)))

    return F.concat(head, F.array_join(F.transform(later, keep), ""))


def trained_chars(text, instruction_part: str = GEMMA_INSTRUCTION_PART,
                  response_part: str = GEMMA_RESPONSE_PART) -> Column:
    """K7 helper: number of characters inside the response spans."""
    spans = response_spans(text, instruction_part, response_part)
    return F.aggregate(spans, F.lit(0).cast("long"), lambda acc, s: acc + F.length(s))
