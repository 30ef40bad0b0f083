"""N1 path values and N2 template expansion, compiled against a schema.

A dotted path walks structs with ``getField``; an array on the way fans
out (``transform`` + ``flatten``); a component ``a or b`` picks the first
alternative that exists in the schema (and, for NULL values, falls back to
the next one). Every path yields ``ARRAY<...>`` of its values, NULLs
dropped, so a template becomes nested ``transform``s over those arrays: one
JVM expression per row, no Python.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


class PathError(KeyError):
    """Path component missing in the schema (the reference raises KeyError)."""


def _alternatives(comp: str) -> list[str]:
    return [a.strip() for a in comp.split(" or ")] if " or " in comp else [comp.strip()]


def _resolve(expr: Column, dtype: T.DataType, comps: list[str]) -> Column:
    """Array column of the values at the end of ``comps`` below ``expr``."""
    if isinstance(dtype, T.ArrayType):
        leaf = _probe_type(dtype.elementType, comps)
        arr = F.flatten(F.transform(expr, lambda x: _resolve(x, dtype.elementType, comps)))
        return F.coalesce(arr, F.array().cast(T.ArrayType(leaf)))
    if not comps:
        return F.filter(F.array(expr), lambda v: v.isNotNull())
    if not isinstance(dtype, T.StructType):
        raise PathError(f"scalar value with remaining path {'.'.join(comps)}")
    names = {f.name: f for f in dtype.fields}
    alts = [a for a in _alternatives(comps[0]) if a in names]
    if not alts:
        raise PathError(comps[0])
    rest = comps[1:]
    if len(alts) == 1:
        return _resolve(expr.getField(alts[0]), names[alts[0]].dataType, rest)
    # the first alternative that the record has, at any level of the path
    leaf = T.ArrayType(_probe_type(dtype, comps))
    out = None
    for a in alts:
        values = _resolve(expr.getField(a), names[a].dataType, rest).cast(leaf)
        out = F.when(expr.getField(a).isNotNull(), values) if out is None else out.when(expr.getField(a).isNotNull(), values)
    return out.otherwise(F.array().cast(leaf))


def _probe_type(dtype: T.DataType, comps: list[str]) -> T.DataType:
    """Leaf type of a path (the element type of the value array)."""
    while True:
        if isinstance(dtype, T.ArrayType):
            dtype = dtype.elementType
            continue
        if not comps:
            return dtype
        if not isinstance(dtype, T.StructType):
            raise PathError(".".join(comps))
        names = {f.name: f for f in dtype.fields}
        alts = [a for a in _alternatives(comps[0]) if a in names]
        if not alts:
            raise PathError(comps[0])
        if len(alts) > 1:
            leaves = [_probe_type(names[a].dataType, comps[1:]) for a in alts]
            return leaves[0] if all(x == leaves[0] for x in leaves) else T.StringType()
        dtype, comps = names[alts[0]].dataType, comps[1:]


def path_values(schema: T.StructType, path: str) -> Column:
    """``ARRAY`` of the values at a dotted path (arrays fan out)."""
    return _resolve(F.struct(*[F.col(f"`{f.name}`") for f in schema.fields]), schema, path.split("."))


_PLACEHOLDER = re.compile(r"\{([^{}]*)\}")


def unescape_template(fmt: str) -> str:
    """Literal ``\\n`` and ``\\t`` in a command-line template become real ones."""
    return fmt.replace("\\n", "\n").replace("\\t", "\t")


def parse_template(fmt: str) -> tuple[list[str], list[str]]:
    """Constant template -> (literal pieces, placeholder paths); len(lits) = len(paths) + 1."""
    lits, paths, pos = [], [], 0
    for m in _PLACEHOLDER.finditer(fmt):
        lits.append(fmt[pos:m.start()])
        paths.append(m.group(1).strip())
        pos = m.end()
    lits.append(fmt[pos:])
    return lits, paths


def expand_template(schema: T.StructType, fmt: str) -> Column:
    """``ARRAY<STRING>`` of all expansions of ``fmt`` for a row.

    Several fan-out placeholders multiply (first placeholder outermost), as
    in the reference; a placeholder without values yields no expansion.
    """
    lits, paths = parse_template(fmt)
    if not paths:
        return F.array(F.lit(fmt))
    arrays = [path_values(schema, p) for p in paths]

    def build(i: int, acc: list[Column]) -> Column:
        if i == len(arrays):
            parts = [F.lit(lits[0])]
            for j, v in enumerate(acc):
                parts += [v.cast("string"), F.lit(lits[j + 1])]
            return F.array(F.concat(*parts))
        return F.flatten(F.transform(arrays[i], lambda v: build(i + 1, acc + [v])))

    return build(0, [])
