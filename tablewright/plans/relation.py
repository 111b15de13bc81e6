"""Named relations with an algebra of joins, filters, unions, selections and groupings.

    person = Relation(df, "person", id_fields=("person_id",), join_as="person")
    (person + message) | (message["posted"] > "2020-01-01")

A relation is a tree over leaves; each node builds a lazy DataFrame in which every leaf's columns
stay addressable as ``leaf["column"]``. Nothing runs before an action.

====================  ==========================================================
``a + b``             inner join            ``a % b``   left outer join
``a.right_join(b)``   right outer join      ``a.full_join(b)``  full outer join
``a - b``             rows without match    ``a ^ b``   rows with a match
``a * b``             every combination     ``a & b``   union by name
``a | condition``     filter                ``a / b``   group by the leaf b
====================  ==========================================================

The right side of a join may be a relation (keys guessed from ``join_as``), ``~b`` (all columns
that both sides have), or ``b.on(...)``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.plans.predicate import Event, Is, Predicate, every, predicate


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


class JoinError(ValueError):
    """No columns to join on."""


@dataclass(frozen=True)
class On:
    """The right side of a join and how to find the condition."""

    right: Relation
    strategy: Callable[[Relation, Relation], list[tuple[Relation, str, Relation, str]]] | None
    condition: Column | None = None

    def resolve(self, left: Relation) -> Column:
        if self.condition is not None:
            return self.condition
        keys = list(dict.fromkeys(self.strategy(left, self.right)))
        if not keys:
            raise JoinError(f"no column joins {left.name} with {self.right.name}: tried {', '.join(self.tried(left))}")
        terms = [one[a] == other[b] for one, a, other, b in keys]
        return every(*(Is(t) for t in terms)).column()

    def tried(self, left: Relation) -> list[str]:
        return [f"{leaf.join_as}{end}" for leaf in (*left.leaves, *self.right.leaves) for end in _FOREIGN]


_FOREIGN = ("_id", "_fk", "")


def _guessed(one: Relation, other: Relation) -> list[tuple[Relation, str, Relation, str]]:
    """For each leaf of ``one``: its id, met by a column of ``other`` that is named after it."""
    found = []
    for leaf in one.leaves:
        foreign = next(((o, leaf.join_as + end) for end in _FOREIGN for o in other.leaves if leaf.join_as + end in o.columns), None)
        own = next((c for c in (*leaf.id_fields, f"{leaf.join_as}_id", f"{leaf.name}_id") if c in leaf.columns), None)
        if foreign and own:
            found.append((leaf, own, *foreign))
    return found


def _auto(left: Relation, right: Relation):
    return _guessed(left, right) + [(b, y, a, x) for a, x, b, y in _guessed(right, left)]


def _common(left: Relation, right: Relation):
    """Columns with one name and type on both sides, each once, from the first leaf that has it."""
    there = {(f.name, f.dataType.simpleString()): leaf for leaf in reversed(right.leaves) for f in leaf.df.schema}
    found: dict = {}
    for leaf in left.leaves:
        for f in leaf.df.schema:
            key = (f.name, f.dataType.simpleString())
            if key in there:
                found.setdefault(key, (leaf, f.name, there[key], f.name))
    return list(found.values())


class Relation:
    """A leaf: a DataFrame with a name.

    ``id_fields`` identify a row (kept where they exist), ``join_as`` is how other tables name a
    reference to this one (default: the name), ``events`` maps event names to timestamp columns.
    """

    nodes: tuple[Relation, ...] = ()

    def __init__(self, df: DataFrame, name: str, id_fields: Sequence[str] = ("id",), join_as: str | None = None, events: dict[str, str] | None = None):
        self.df, self.name, self.id_fields, self.join_as = df.alias(name), name, tuple(id_fields), join_as or name
        self.events = events or {}
        self.columns = tuple(df.columns)

    # columns
    @property
    def leaves(self) -> tuple[Relation, ...]:
        return (self,)

    def __getitem__(self, column: str) -> Column:
        if column not in self.columns:
            raise KeyError(f"{self.name} has no column {column}")
        return F.col(f"{quoted(self.name)}.{quoted(column)}")

    def event(self, name: str | None = None) -> Event:
        """An event of this relation: a named one, or its only one."""
        column = self.events.get(name, name) if name else next(iter(self.events.values()))
        return Event(self[column])

    def happens(self) -> Event:
        return self.event()

    def starts(self) -> Event:
        return self.event("starts")

    def ends(self) -> Event:
        return self.event("ends")

    # joins
    def on(self, *keys: str | tuple | Column) -> On:
        """Join this relation on columns of one name, ``(left, right)`` names, ``(leaf, column)`` or
        any condition."""
        if len(keys) == 1 and isinstance(keys[0], (Column, Predicate)):
            return On(self, None, predicate(keys[0]).column())
        pairs = [(k, k) if isinstance(k, str) else k for k in keys]
        holders = {b: next((leaf for leaf in self.leaves if b in leaf.columns), None) for _, b in pairs}
        if missing := [b for b, leaf in holders.items() if leaf is None]:
            raise JoinError(f"{self.name} has no column {', '.join(missing)}")

        def named(left: Relation, right: Relation):
            found = []
            for a, b in pairs:
                if isinstance(a, Relation):
                    found += [(leaf, b, holders[b], b) for leaf in left.leaves if leaf.name == a.name]
                else:
                    found += [(leaf, a, holders[b], b) for leaf in left.leaves if a in leaf.columns]
            return found

        return On(self, named)

    def __invert__(self) -> On:
        return On(self, _common)

    def join(self, other: Relation | On, how: str, mark: str = "w") -> Relation:
        other = other if isinstance(other, On) else On(other, _auto)
        return Joined(self, other.right, other.resolve(self), how, mark)

    def inner_join(self, other) -> Relation:
        return self.join(other, "inner")

    def left_join(self, other) -> Relation:
        return self.join(other, "left")

    def right_join(self, other) -> Relation:
        return self.join(other, "right")

    def full_join(self, other) -> Relation:
        return self.join(other, "full")

    def anti_join(self, other) -> Relation:
        return self.join(other, "left_anti", "wo")

    def semi_join(self, other) -> Relation:
        return self.join(other, "left_semi", "ex")

    def cross_join(self, other: Relation) -> Relation:
        return Joined(self, other, None, "cross", "by")

    __add__, __mod__, __sub__, __xor__, __mul__ = inner_join, left_join, anti_join, semi_join, cross_join

    # filters, unions, names
    def where(self, condition: Predicate | Column) -> Relation:
        return Filtered(self, predicate(condition))

    __or__ = where

    def union(self, other: Relation, by_name: bool = True) -> Relation:
        """Both relations' rows as one leaf under this one's name."""
        rows = self.df.unionByName(other.df) if by_name else self.df.union(other.df)
        out = Relation(rows, self.name, self.id_fields, self.join_as, self.events)
        out.nodes = (self, other)
        return out

    def __and__(self, other: Relation) -> Relation:
        return self.union(other)

    def alias(self, name: str) -> Relation:
        """This relation as one leaf of another name, to join it with itself."""
        if len(set(self.columns)) < len(self.columns):
            raise ValueError(f"{self.name} has columns of one name; select them with prefixes first")
        out = Relation(self.df, name, self.id_fields, self.join_as if len(self.leaves) == 1 else name, self.events)
        out.nodes = (self,)
        return out

    # selections
    def select(self, *parts: Relation | tuple[Relation, str]) -> DataFrame:
        """Columns of the given relations (all leaves if none), prefixed: by ``{name}_``, or by the
        text that comes with the relation."""
        pairs = [p if isinstance(p, tuple) else (p, f"{p.name}_") for p in (parts or self.leaves)]
        return self.df.select(*(rel[c].alias(prefix + c) for rel, prefix in pairs for leaf in rel.leaves for c in leaf.columns))

    def select_plain(self, *parts: Relation, skip_duplicates: bool = True) -> DataFrame:
        """Columns without prefixes; of one name only the first, if ``skip_duplicates``."""
        seen: set[str] = set()
        chosen = []
        for leaf in (x for rel in (parts or self.leaves) for x in rel.leaves):
            for c in leaf.columns:
                if not (skip_duplicates and c in seen):
                    seen.add(c)
                    chosen.append(leaf[c].alias(c))
        return self.df.select(*chosen)

    # groupings
    def group_by(self, *by: Relation | tuple[Relation, Iterable[str]], agg: Callable[[Relation], Column] | None = None) -> DataFrame:
        """Group by leaves, or by columns of leaves; one aggregate for every other leaf, under its name.

        A leaf alone stands for its id fields, or for all its columns where it lacks those. Its
        other columns come with any one value of the group, which is well defined when the keys
        determine them.
        """
        if not by:
            raise ValueError("nothing to group on")
        groups = [(b, None) if isinstance(b, Relation) else (b[0], tuple(b[1])) for b in by]
        for leaf, columns in groups:
            if leaf.name not in {x.name for x in self.leaves}:
                raise ValueError(f"{leaf.name} is not a leaf of {self.name}")
            if columns == ():
                raise ValueError(f"nothing to group on for {leaf.name}")
        chosen = [(leaf, columns or (leaf.id_fields if set(leaf.id_fields) <= set(leaf.columns) else leaf.columns)) for leaf, columns in groups]
        keys = [leaf[c].alias(c) for leaf, columns in chosen for c in columns]
        carried = [F.first(leaf[c]).alias(c) for leaf, columns in chosen for c in leaf.columns if c not in columns]
        others = [(agg or count_distinct)(leaf) for leaf in self.leaves if leaf.name not in {g.name for g, _ in groups}]
        return self.df.groupBy(*keys).agg(*carried, *others) if carried or others else self.df.select(*keys).distinct()

    def __truediv__(self, by: Relation) -> DataFrame:
        return self.group_by(by)

    # traversal
    def tree(self, depth: int = 0) -> str:
        line = "  | " * max(0, depth - 1) + ("  |- " if depth else "") + f"[{type(self).__name__}] {self.name}"
        return "\n".join([line, *(node.tree(depth + 1) for node in self.nodes)])

    def __repr__(self) -> str:
        return self.name


class _Composite(Relation):
    """A relation over several leaves, whose DataFrame holds all their columns."""

    def __init__(self, df: DataFrame, name: str, leaves: tuple[Relation, ...], nodes: tuple[Relation, ...], join_as: str):
        self.df, self.name, self.nodes, self._leaves, self.join_as = df, name, nodes, leaves, join_as
        self.id_fields, self.events = leaves[0].id_fields, leaves[0].events
        self.columns = tuple(c for leaf in leaves for c in leaf.columns)

    @property
    def leaves(self) -> tuple[Relation, ...]:
        return self._leaves

    def __getitem__(self, column: str) -> Column:
        holders = [leaf for leaf in self.leaves if column in leaf.columns]
        if len(holders) != 1:
            raise KeyError(f"{column} is in {len(holders)} leaves of {self.name}: {[h.name for h in holders]}")
        return holders[0][column]


class Joined(_Composite):
    def __init__(self, left: Relation, right: Relation, on: Column | None, how: str, mark: str):
        if clash := {x.name for x in left.leaves} & {x.name for x in right.leaves}:
            raise JoinError(f"both sides have a leaf {', '.join(sorted(clash))}; alias one of them")
        df = left.df.crossJoin(right.df) if on is None else left.df.join(right.df, on, how)
        leaves = left.leaves if how in ("left_semi", "left_anti") else (*left.leaves, *right.leaves)
        super().__init__(df, f"{left.name}__{mark}_{right.name}", leaves, (left, right), left.join_as)
        self.on_condition, self.how = on, how


class Filtered(_Composite):
    """A filter; filters on a filter merge into one condition."""

    def __init__(self, base: Relation, condition: Predicate):
        if isinstance(base, Filtered):
            base, condition = base.nodes[0], base.condition & condition
        df = base.df.where(condition.column())
        super().__init__(df, base.name, base.leaves, (base,), base.join_as)
        self.condition = condition


def count_distinct(leaf: Relation) -> Column:
    """How many rows of the leaf: by its id fields, or by its columns that can't be null."""
    if set(leaf.id_fields) <= set(leaf.columns):
        return count_distinct_ids(leaf)
    return count_distinct_required(leaf)


def count_distinct_ids(leaf: Relation) -> Column:
    return F.count_distinct(*(leaf[c] for c in leaf.id_fields)).alias(leaf.name)


def count_distinct_required(leaf: Relation) -> Column:
    columns = [f.name for f in leaf.df.schema if not f.nullable]
    if not columns:
        raise ValueError(f"{leaf.name} has no column that can't be null")
    return F.count_distinct(*(leaf[c] for c in columns)).alias(leaf.name)


def count_all(leaf: Relation) -> Column:
    column = next((c for c in leaf.id_fields if c in leaf.columns), leaf.columns[0])
    return F.count(leaf[column]).alias(leaf.name)
