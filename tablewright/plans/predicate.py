"""Predicates that simplify as they combine, and events that happen at a point in time."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


class Predicate:
    """A condition that combines with ``&``, ``|`` and ``~`` and becomes a Column at the end."""

    def column(self) -> Column:
        raise NotImplementedError

    def negated(self) -> Predicate:
        return Not(self)

    def __and__(self, other: Predicate | Column) -> Predicate:
        return every(self, predicate(other))

    def __or__(self, other: Predicate | Column) -> Predicate:
        return some(self, predicate(other))

    def __invert__(self) -> Predicate:
        return self.negated()


@dataclass(frozen=True, eq=False)
class Is(Predicate):
    """A boolean Column."""

    condition: Column

    def column(self) -> Column:
        return self.condition


@dataclass(frozen=True, eq=False)
class Not(Predicate):
    inner: Predicate

    def column(self) -> Column:
        return ~self.inner.column()

    def negated(self) -> Predicate:
        return self.inner


@dataclass(frozen=True, eq=False)
class Every(Predicate):
    parts: tuple[Predicate, ...]

    def column(self) -> Column:
        return reduce(and_, (p.column() for p in self.parts))

    def negated(self) -> Predicate:
        return some(*(~p for p in self.parts))


@dataclass(frozen=True, eq=False)
class Some(Predicate):
    parts: tuple[Predicate, ...]

    def column(self) -> Column:
        return reduce(or_, (p.column() for p in self.parts))

    def negated(self) -> Predicate:
        return every(*(~p for p in self.parts))


@dataclass(frozen=True)
class Constant(Predicate):
    """Always true, always false, or (None) no condition at all: neutral in every combination."""

    value: bool | None

    def column(self) -> Column:
        return F.lit(self.value is not False)

    def negated(self) -> Predicate:
        return self if self.value is None else Constant(not self.value)


TRUE, FALSE, EMPTY = Constant(True), Constant(False), Constant(None)


def predicate(value: Predicate | Column | bool) -> Predicate:
    if isinstance(value, Predicate):
        return value
    return Constant(value) if isinstance(value, bool) else Is(value)


def _combined(kind: type, parts: tuple[Predicate, ...], absorbing: Constant, neutral: Constant) -> Predicate:
    flat: list[Predicate] = []
    for part in parts:
        flat += part.parts if isinstance(part, kind) else [part]
    if any(part == absorbing for part in flat):
        return absorbing
    left = [part for part in flat if part not in (EMPTY, neutral)]
    if left:
        return left[0] if len(left) == 1 else kind(tuple(left))
    return neutral if neutral in flat else EMPTY


def every(*parts: Predicate) -> Predicate:
    """All of them hold."""
    return _combined(Every, parts, FALSE, TRUE)


def some(*parts: Predicate) -> Predicate:
    """At least one holds."""
    return _combined(Some, parts, TRUE, FALSE)


class Event(Predicate):
    """A timestamp Column: null means it has not happened.

    Compared with another event, a datetime or nothing (now); ``before`` and ``after`` include the
    moment itself. Used as a predicate it asks whether the event happened.
    """

    def __init__(self, at: Column | datetime | str):
        self.at = at if isinstance(at, Column) else F.lit(at).cast("timestamp")

    @classmethod
    def now(cls) -> Event:
        return cls(F.current_timestamp())

    def column(self) -> Column:
        return self.at.isNotNull()

    def negated(self) -> Predicate:
        return Is(self.at.isNull())

    @staticmethod
    def _time(other: Event | Column | datetime | str | None) -> Column:
        return Event.now().at if other is None else other.at if isinstance(other, Event) else Event(other).at

    def __lt__(self, other) -> Predicate:
        return Is(self.at < self._time(other))

    def __le__(self, other) -> Predicate:
        return Is(self.at <= self._time(other))

    def __gt__(self, other) -> Predicate:
        return Is(self.at > self._time(other))

    def __ge__(self, other) -> Predicate:
        return Is(self.at >= self._time(other))

    def before(self, other=None) -> Predicate:
        return self <= other

    def after(self, other=None) -> Predicate:
        return self >= other

    def __add__(self, interval: str) -> Event:
        """Later by an interval such as "2 days"."""
        return Event(self.at + F.expr(f"INTERVAL {interval}"))

    def __sub__(self, interval: str) -> Event:
        return Event(self.at - F.expr(f"INTERVAL {interval}"))


class Entity:
    """Something that user code compares as a whole: define ``same_as`` to use ``same``/``differs``."""

    def same_as(self, other) -> Predicate:
        raise NotImplementedError

    def same(self, other) -> Predicate:
        return self.same_as(other)

    def differs(self, other) -> Predicate:
        return ~self.same_as(other)
