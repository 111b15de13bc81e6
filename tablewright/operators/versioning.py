"""Slowly changing tables: merges of types 1 and 2, soft deletes, archives, keyed updates.

All of them compute the new table as a DataFrame from the old one and the candidates; writing it
(see sources.tables) stages and swaps. Keys match by SQL equality, so a null key matches nothing
and is inserted anew, unless ``null_safe``. Rows count as changed where a tracked column differs,
nulls included; no hash is needed, and a hash column, if there is one, is just another column.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.operators.schema import col


class DuplicateKeys(ValueError):
    """Several candidates for one key."""


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df``, after a look whether its non-null keys occur once."""
    known = reduce(and_, (col(k).isNotNull() for k in keys))
    twice = df.where(known).groupBy(*(col(k) for k in keys)).count().where("count > 1").limit(3).collect()
    if twice:
        raise DuplicateKeys(f"several candidates for one key, such as {[r.asDict() for r in twice]}")
    return df


def _matching(keys: list[str], null_safe: bool = False, a: str = "t", b: str = "s") -> Column:
    pairs = ((F.col(f"{a}.`{k}`"), F.col(f"{b}.`{k}`")) for k in keys)
    return reduce(and_, (x.eqNullSafe(y) if null_safe else x == y for x, y in pairs))


def changed(columns: list[str], a: str = "t", b: str = "s") -> Column:
    """Whether any of the columns differs between both sides."""
    return reduce(or_, (~F.col(f"{a}.`{c}`").eqNullSafe(F.col(f"{b}.`{c}`")) for c in columns), F.lit(False))


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    columns: list[str] | None = None,
    mode: str = "iu",
    compare: list[str] | None = None,
    update_when: Column | None = None,
    delete_when: Column | None = None,
    in_scope: Column | None = None,
    set_unmatched: dict[str, Column] | None = None,
    null_safe: bool = False,
    check_keys: bool = True,
) -> DataFrame:
    """The target after a merge with the source, in one full outer join.

    ``mode`` holds i (insert unmatched source rows), u (update matched rows) and d (delete matched
    rows). ``columns`` are updated (default: all the source has), where a column of ``compare``
    (default: those) differs and ``update_when`` holds; with d, matched rows that ``delete_when``
    accepts go (default: all). Both conditions see the sides as ``t`` and ``s``. Target rows
    outside ``in_scope`` (a condition on target columns) match nothing and stay as they are;
    ``set_unmatched`` changes target rows in scope without a source row, for soft deletes.
    """
    if set(mode) - set("iud"):
        raise ValueError(f"mode {mode!r}: letters i, u and d")
    if check_keys:
        require_unique(source, keys)
    names = target.columns
    columns = [c for c in (columns or source.columns) if c not in keys and c in names]
    scope = F.lit(True) if in_scope is None else F.coalesce(in_scope, F.lit(False))
    t = target.withColumns({"_t": F.lit(True), "_scope": scope}).alias("t")
    s = source.withColumn("_s", F.lit(True)).alias("s")
    both = t.join(s, _matching(keys, null_safe) & F.col("t._scope"), "full")
    matched = F.col("_t").isNotNull() & F.col("_s").isNotNull()
    new = F.col("_t").isNull()
    wanted = F.lit(True) if update_when is None else F.coalesce(update_when, F.lit(False))
    update = matched & changed(compare or columns) & wanted if "u" in mode else F.lit(False)
    drop = F.lit(False)
    if "d" in mode:
        drop = matched & (F.lit(True) if delete_when is None else F.coalesce(delete_when, F.lit(False)))
    keep = ~(drop | (F.lit("i" not in mode) & new))
    unmatched = F.col("_s").isNull() & F.col("t._scope")

    def value(n: str) -> Column:
        own, theirs = F.col(f"t.`{n}`"), F.col(f"s.`{n}`") if n in source.columns else F.lit(None)
        out = F.when(new, theirs)
        if n in columns:
            out = out.when(update, theirs)
        if set_unmatched and n in set_unmatched:
            out = out.when(unmatched, set_unmatched[n])
        return out.otherwise(own).cast(target.schema[n].dataType).alias(n)

    return both.where(keep).select(*(value(n) for n in names))


def scd1(target: DataFrame | None, source: DataFrame, keys: list[str], **how) -> DataFrame:
    """Type 1: insert new keys, update changed rows, keep the others. No target: the source."""
    return require_unique(source, keys) if target is None else merge(target, source, keys, **how)


def scd2(target: DataFrame, source: DataFrame, keys: list[str], pk: str, end: str, as_of: Column | None = None, compare: list[str] | None = None, check_keys: bool = True) -> DataFrame:
    """Type 2: history by an end date that is null in open rows.

    A candidate whose key has no open row, or an open row that differs, is added as an open row;
    the differing open row is closed at ``as_of`` (default: now), by its ``pk``. Open rows without
    a candidate stay open. Rows whose ``pk`` the source doesn't have get a null there.
    """
    if check_keys:
        require_unique(source, keys)
    as_of = F.current_timestamp() if as_of is None else as_of
    tracked = compare or [c for c in source.columns if c not in (*keys, pk, end) and c in target.columns]
    kind = target.schema[end].dataType
    t, s = target.where(col(end).isNull()).alias("t"), source.alias("s")
    stale = t.join(s, _matching(keys)).where(changed(tracked)).select(F.col(f"t.`{pk}`").alias("_closed")).distinct()
    closed = target.join(stale, col(pk) == F.col("_closed"), "left")
    closed = closed.withColumn(end, F.when(F.col("_closed").isNotNull() & col(end).isNull(), as_of.cast(kind)).otherwise(col(end))).drop("_closed")
    fresh = s.join(t, _matching(keys) & ~changed(tracked), "left_anti").withColumn(end, F.lit(None).cast(kind))
    return closed.unionByName(fresh.select(*(c for c in fresh.columns if c in target.columns)), allowMissingColumns=True).select(*(col(c) for c in target.columns))


def archived(keys: list[str], newest: DataFrame, *older: DataFrame) -> DataFrame:
    """The newest rows, and from each older table, newer ones first, the keys not there yet.

    All tables are read once and ranked by age within a key. Null keys match nothing: their rows stay.
    """
    rows = reduce(DataFrame.unionByName, (t.withColumn("_age", F.lit(i)) for i, t in enumerate((newest, *older))))
    known = reduce(and_, (col(k).isNotNull() for k in keys))
    by_age = Window.partitionBy(*(col(k) for k in keys)).orderBy(F.when(known, F.col("_age")).otherwise(0))
    return rows.withColumn("_rank", F.rank().over(by_age)).where("_rank = 1").select(*(col(c) for c in newest.columns))


def change_sets(target: DataFrame, source: DataFrame, keys: list[str], compare: list[str]) -> dict[str, DataFrame]:
    """The source rows to insert, the source rows to update, and the target rows without a source."""
    t, s = target.alias("t"), source.alias("s")
    return {
        "insert": s.join(t, _matching(keys), "left_anti"),
        "update": s.join(t, _matching(keys) & changed(compare), "left_semi"),
        "delete": t.join(s, _matching(keys), "left_anti"),
    }
