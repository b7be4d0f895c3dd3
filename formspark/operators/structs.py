"""Struct projections: unnest with a prefix, column ordering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def column(*path: str) -> Column:
    """A column (or field of it) by its literal name, whatever characters it has."""
    return F.col(".".join("`" + p.replace("`", "``") + "`" for p in path))


def distinct_names(names: list[str]) -> list[str]:
    """``names`` with ``__2``, ``__3`` ... behind those that equal an earlier one but for case."""
    used: set[str] = set()
    out = []
    for name in names:
        new, n = name, 1
        while new.casefold() in used:
            n += 1
            new = f"{name}__{n}"
        used.add(new.casefold())
        out.append(new)
    return out


def field_names(df: DataFrame, struct_col: str) -> list[str]:
    dt = df.schema[struct_col].dataType
    if not isinstance(dt, T.StructType):
        raise TypeError(f"{struct_col} is not a struct column")
    return [f.name for f in dt.fields]


def unnest(df: DataFrame, struct_col: str, prefix: str | None = None) -> list[Column]:
    """Columns ``<prefix><field>`` for every field of ``struct_col`` (prefix defaults to ``<col>_``)."""
    p = f"{struct_col}_" if prefix is None else prefix
    return [column(struct_col, f).alias(f"{p}{f}") for f in field_names(df, struct_col)]


def unnest_structs(df: DataFrame, *struct_cols: str, drop: bool = True) -> DataFrame:
    """Replace (or extend) struct columns by their prefixed fields, in place."""
    out: list[Column] = []
    for c in df.columns:
        if c in struct_cols:
            if not drop:
                out.append(column(c))
            out.extend(unnest(df, c))
        else:
            out.append(column(c))
    return df.select(*out)


def column_order(names: list[str], index_prefixes: tuple[str, ...], fixed: list[str]) -> list[int]:
    """Positions of ``names``: ``fixed`` ones in their order, other names that start with an index
    prefix by name, the remaining ones by name."""
    at = {n: i for i, n in reversed(list(enumerate(names)))}
    first = [at[c] for c in fixed if c in at]
    rest = sorted(set(range(len(names))) - set(first), key=lambda i: (not names[i].startswith(index_prefixes), names[i], i))
    return first + rest


def order_columns(df: DataFrame, index_prefixes: tuple[str, ...], fixed: list[str]) -> DataFrame:
    """Index columns first (``fixed`` in order, then other names starting with an
    index prefix), the remaining columns sorted by name."""
    return df.select(*[column(df.columns[i]) for i in column_order(df.columns, index_prefixes, fixed)])
