"""Star-schema model: named tables and the relationships between them."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


def split_ref(ref: str) -> tuple[str, str]:
    table, column = ref.split(".", 1)
    return table, column


@dataclass(frozen=True)
class Relationship:
    """Many-to-one: ``source`` looks up ``target``.

    ``active`` relationships apply by default, others only through a metric's
    ``via``. ``both`` marks that filters also flow from source to target.
    ``semi`` marks a fact-to-fact relation, usable for restriction only.
    """

    source: str
    target: str
    active: bool = True
    both: bool = False
    semi: bool = False

    @property
    def pair(self) -> tuple[str, str]:
        return self.source, self.target


#: Pairs of columns over which a filter goes from table to table.
Route = tuple[tuple[str, str], ...]


@dataclass
class Model:
    """Tables (loaded on demand), the relationships between them, and which are date tables."""

    loaders: dict[str, Callable[[], DataFrame]]
    relationships: tuple[Relationship, ...]
    date_tables: frozenset[str] = frozenset({"DimDatum"})
    _cache: dict[str, DataFrame] = field(default_factory=dict, repr=False)

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.loaders[name]()
        return self._cache[name]

    def replacing(self, loaders: dict[str, Callable[[], DataFrame]]) -> "Model":
        """The same model with some tables replaced, such as restricted ones."""
        return Model({**self.loaders, **loaders}, self.relationships, self.date_tables)

    def path(
        self, start: str, goal: str, via: Iterable[tuple[str, str]] = (), without: Iterable[str] = (),
        treat: Iterable[tuple[str, str]] = (),
    ) -> list[Relationship] | None:
        """Lookup path from a table to a dimension; roles named in ``via`` and relations made by ``treat`` win."""
        chosen, cut = {*via, *treat}, set(without)
        own = {r.pair for r in self.relationships}
        usable = [
            r
            for r in [*self.relationships, *(Relationship(*pair) for pair in dict.fromkeys(treat) if pair not in own)]
            if not r.semi and (r.active or r.pair in chosen) and split_ref(r.target)[0] not in cut
        ]
        found: list[list[Relationship]] = []

        def walk(at: str, taken: list[Relationship], seen: set[str]) -> None:
            if at == goal:
                found.append(taken)
                return
            for r in usable:
                target = split_ref(r.target)[0]
                if split_ref(r.source)[0] == at and target not in seen:
                    walk(target, taken + [r], seen | {target})

        walk(start, [], {start})
        if not found:
            return None
        return min(found, key=lambda p: (-sum(r.pair in chosen for r in p), len(p)))

    def carriers(self, start: str, tables: Iterable[str], without: Iterable[str] = ()) -> Route | None:
        """The shortest way on which a filter on ``tables`` reaches ``start`` where no lookup leads to them.

        Filters flow from the looked-up side of a relation to the other, and back where the relation is ``both``. The walk
        goes breadth-first over tables and visits each once, so circles of relations end it.
        """
        wanted, cut = set(tables), set(without)
        flows: dict[str, list[tuple[str, str]]] = {}
        for r in self.relationships:
            if r.active and split_ref(r.target)[0] not in cut:
                flows.setdefault(split_ref(r.target)[0], []).append((r.target, r.source))
                if r.both:
                    flows.setdefault(split_ref(r.source)[0], []).append((r.source, r.target))
        # the filter is first told on a table that looks up all its columns: its own, if it is on one
        reach = lambda h: all(t == h or self.path(h, t, (), cut) is not None for t in wanted)
        ways: dict[str, list[tuple[str, str]]] = {t: [] for t in ([*wanted] if len(wanted) == 1 else flows) if t != start and reach(t)}
        waiting = list(ways)
        while waiting:
            at = waiting.pop(0)
            for here, there in flows.get(at, []):
                table = split_ref(there)[0]
                if table not in ways:
                    ways[table] = [*ways[at], (here, there)]
                    waiting.append(table)
        if not ways.get(start):
            return None
        steps = ways[start]
        # as far as plain lookups lead, the filter is told by lookups; from there on by semi-joins
        while len(steps) > 1 and reach(split_ref(steps[0][1])[0]):
            steps = steps[1:]
        return tuple(steps)
