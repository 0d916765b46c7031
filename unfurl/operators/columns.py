"""Column operators (C1-C7), row predicates (D1-D5) and the item generator.

All are projections or filters Catalyst can push, prune and fuse into one
whole-stage-codegen span; none of them shuffles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def q(name: str) -> str:
    """Quote a column name for resolution (dots, ``@`` and spaces stay literal)."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(q(name))


# -- C1 / C4 -----------------------------------------------------------------

def select_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Ordered projection by literal column names."""
    return df.select(*[col(n) for n in names])


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """C4: remove columns; absent names are ignored."""
    return df.drop(*names)


# -- C2 / C3 -----------------------------------------------------------------

def expand(df: DataFrame, struct_col: str, keep: Iterable[str] = ()) -> DataFrame:
    """``select("s.*")`` - the struct's fields become columns."""
    return df.select(*[col(k) for k in keep], F.col(f"{q(struct_col)}.*"))


def leaves(df: DataFrame, mapping: Mapping[str, str | Column],
           drop: Iterable[str] = ()) -> DataFrame:
    """C3 (+C4): copy nested leaves (``"a.b.c"`` paths) to top-level columns in
    one projection, then drop the listed source columns."""
    exprs = {n: (F.col(p) if isinstance(p, str) else p) for n, p in mapping.items()}
    return df.withColumns(dict(exprs)).drop(*drop)


# -- C5 / C6 / C7 ------------------------------------------------------------

class ColumnNameCollision(ValueError):
    pass


def sanitize_names(df: DataFrame, old: str = ".", new: str = "_") -> DataFrame:
    """Rename columns replacing ``old`` by ``new`` (``a.b`` -> ``a_b``).

    Two names that map to the same result (``a.b`` next to ``a_b``) would make
    every later use ambiguous, so that is reported up front.
    """
    renamed = [c.replace(old, new) for c in df.columns]
    seen: dict[str, str] = {}
    clashes = []
    for before, after in zip(df.columns, renamed):
        if after in seen:
            clashes.append((seen[after], before, after))
        seen[after] = before
    if clashes:
        detail = ", ".join(f"{a!r} and {b!r} -> {c!r}" for a, b, c in clashes)
        raise ColumnNameCollision(f"renaming makes duplicate columns: {detail}")
    return df.toDF(*renamed)


def ensure_columns(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Add each absent column as a constant (a typed null when the default
    is a Column or None is allowed too); present columns are left alone."""
    present = set(df.columns)
    missing = {n: (v if isinstance(v, Column) else F.lit(v))
               for n, v in defaults.items() if n not in present}
    return df.withColumns(missing) if missing else df


def map_columns(df: DataFrame, names: Iterable[str],
                fn: Callable[[DataFrame, str], Column]) -> DataFrame:
    """Apply one column rule to a list of columns in a single projection."""
    return df.withColumns({n: fn(df, n) for n in names})


# -- D1-D5 -------------------------------------------------------------------

def is_not_null(name: str) -> Column:
    """Null test on a scalar, struct or array column."""
    return col(name).isNotNull()


def equals(name: str, value) -> Column:
    """Equality with a constant (null never matches)."""
    return col(name) == F.lit(value)


def non_empty(name: str) -> Column:
    """D3: ``!= ''``; null fails too (three-valued logic)."""
    return col(name) != F.lit("")


def contains_text(name: str, text: str) -> Column:
    """Literal substring test; on a text scan it is pushed as StringContains."""
    return col(name).contains(text)


def where_all(df: DataFrame, *predicates: Column) -> DataFrame:
    """Conjunction of predicates (Catalyst merges them into one Filter)."""
    if not predicates:
        return df
    cond = predicates[0]
    for p in predicates[1:]:
        cond = cond & p
    return df.where(cond)


# -- E1 ----------------------------------------------------------------------

def explode_items(df: DataFrame, array_col: str, alias: str = "item",
                  outer: bool = False, drop_source: bool = True) -> DataFrame:
    """One row per array element. Null and empty arrays drop their row
    unless ``outer=True`` (then one row with a null element)."""
    gen = F.explode_outer if outer else F.explode
    out = df.withColumn(alias, gen(col(array_col)))
    return out.drop(array_col) if drop_source else out
