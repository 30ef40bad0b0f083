"""String and scalar functions: X3, X6-X11, X15, M1, M3.

All return Columns; nothing here runs Python per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that a Python ``str.strip()`` removes.
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
              "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")

# What a Python ``float()`` reads, without underscores.
NUMBER = r"^[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|(?i:inf|infinity|nan))$"


def _number(c: Column) -> Column:
    """NULL for text that only Java reads as a number (``12.5f``)."""
    return F.when(c.rlike(NUMBER), c.try_cast("double"))

# Quantisation names of exported model files.
QUANTISATIONS = ["F32", "F16", "BF16", "Q8_0"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Python ``str.strip()`` (Spark ``trim`` only drops blanks)."""
    return F.btrim(_c(c), F.lit(WHITESPACE))


def first_line(c) -> Column:
    return F.substring_index(_c(c), "\n", 1)


def remove_prefix(c, prefix: str) -> Column:
    """Drop ``prefix`` once if present."""
    c = _c(c)
    return F.when(c.startswith(prefix), F.substr(c, F.lit(len(prefix) + 1))).otherwise(c)


def preview(c, n: int, suffix: str = "...", always: bool = False) -> Column:
    """First ``n`` characters plus ``suffix`` (only when longer, unless ``always``)."""
    c = _c(c)
    cut = F.concat(F.left(c, F.lit(n)), F.lit(suffix))
    if always:
        return cut
    return F.when(F.length(c) > n, cut).otherwise(c)


def continuation(generated, prompt) -> Column:
    """Generated text after the prompt's length, stripped."""
    g = _c(generated)
    return strip(F.substr(g, F.length(_c(prompt)) + 1))


def _as_list(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def _cut_at(marker: str, side: int):
    return lambda t: F.when(F.instr(t, marker) > 0, F.substring_index(t, marker, side))


def marker_split(c, left: str | Sequence[str] | None = None,
                 right: str | Sequence[str] | None = None,
                 first_line_only: bool = False) -> Column:
    """Keep the text after the last ``left`` marker(s) and before the first
    ``right`` marker(s), applied in order, then strip.

    A missing marker yields NULL (the reference raises); rows with NULL are
    the rejects. With neither side given the content is returned unstripped.
    """
    out = _c(c)
    lefts, rights = _as_list(left), _as_list(right)
    if lefts or rights:
        for m, side in [*((m, -1) for m in lefts), *((m, 1) for m in rights)]:
            out = _let(out, _cut_at(m, side))
        out = strip(out)
    if first_line_only:
        out = first_line(out)
    return out


def parse_score(c) -> Column:
    """Numeric score of a scorer result text.

    NULL -> -1; text after the last ``tasks):``; first white-space token;
    one trailing ``%`` dropped (no division by 100). Unparsable -> NULL.
    """
    c = _c(c)
    s = F.when(F.instr(c, "tasks):") > 0, F.substring_index(c, "tasks):", -1)).otherwise(c)
    bare = lambda t: F.when(t.endswith("%"), F.left(t, F.length(t) - 1)).otherwise(t)
    tok = F.regexp_extract(s, f"^[{WHITESPACE}]*([^{WHITESPACE}]*)", 1)
    return F.when(c.isNull(), F.lit(-1.0)).otherwise(_let(tok, lambda t: _let(bare(t), _number)))


def parse_margin(c) -> Column:
    """The ``y`` of ``x +/- y``; NULL unless a number as in X9."""
    return _let(F.regexp_extract(_c(c), r"\+/-\s*([^\s%]+)", 1), _number)


def parse_interval(c) -> tuple[Column, Column]:
    """Bounds of ``[lo%, hi%]``; NULL unless numbers as in X9."""
    pat = r"\[\s*([^,%\]\s]+)%?\s*,\s*([^,%\]\s]+)%?\s*\]"
    c = _c(c)
    return (_let(F.regexp_extract(c, pat, 1), _number), _let(F.regexp_extract(c, pat, 2), _number))


def model_name(path) -> Column:
    """X11: base name without the last extension and without a ``-00001-of-`` tail."""
    base = F.substring_index(_c(path), "/", -1)
    no_ext = F.regexp_replace(base, r"\.[^.]*$", "")
    return F.regexp_replace(no_ext, r"(?s)^(.*)-00001-of-.*$", "$1")


def artifact_name(base, quantisation) -> Column:
    """``{base}-{quant lower}.gguf``."""
    return F.concat(_c(base), F.lit("-"), F.lower(_c(quantisation)), F.lit(".gguf"))


def artifact_quantisation(name) -> Column:
    """X15 inverse: quantisation suffix of a model name (empty if none)."""
    alts = "|".join(q.lower() for q in QUANTISATIONS)
    return F.regexp_extract(F.lower(_c(name)), rf"-({alts})$", 1)


def percent(n, total, digits: int | None = None) -> Column:
    """M1: ``100 * n / total``; NULL when total is 0. Rounded only on request."""
    v = F.try_divide(F.lit(100.0) * _c(n), _c(total))
    return F.round(v, digits) if digits is not None else v


def elapsed_seconds(start, end) -> Column:
    """M3: whole seconds between two timestamps."""
    return F.timestamp_diff("SECOND", _c(start), _c(end))


def elapsed_seconds_exact(start, end) -> Column:
    """Seconds with microsecond precision between two timestamps."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(1e6)
