"""Evaluate metrics by any grouping and filters, as one DataFrame plan.

Per fact (and per effective grouping, lookups and date shift) the plan is: scan
the needed columns, filter, look the dimensions up with left joins, aggregate
every metric of that fact at once. Facts are added up first and only then
brought together, so no fact is ever joined to another one.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import functools
import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallygrid.operators.joins import on_key
from tallygrid.plans.metric import Base, Metric, Pred, bases, between, rewrite
from tallygrid.plans.model import Model, Relationship, Route, split_ref

LEVEL = "grouping_level"
Span = tuple[str, dt.date | None, dt.date | None]


def _q(ref: str) -> Column:
    return F.col(f"`{ref}`")


def _all(conditions: Sequence[Column]) -> Column | None:
    return functools.reduce(lambda a, b: a & b, conditions) if conditions else None


def _any(conditions: Sequence[Column]) -> Column:
    return functools.reduce(lambda a, b: a | b, conditions)


def _when(condition: Column | None, value: Column) -> Column:
    return value if condition is None else F.when(condition, value)


def _months_before(day: dt.date, months: int) -> dt.date:
    n = day.year * 12 + day.month - 1 - months
    return dt.date(n // 12, n % 12 + 1, 1)


#: Windows around the last day of a group of dates: first and last day that are read.
WINDOWS = {
    "year_to_date": lambda last: (F.trunc(last, "year"), last),
    "month_before": lambda last: (F.add_months(F.trunc(last, "month"), -1), F.date_sub(F.trunc(last, "month"), 1)),
}


def _window_days(name: str, last: dt.date) -> tuple[dt.date, dt.date]:
    """The days of a window around a day that is known beforehand."""
    if name == "year_to_date":
        return last.replace(month=1, day=1), last
    before = last.replace(day=1) - dt.timedelta(days=1)
    return before.replace(day=1), before


def _settled(metric: Metric, by: list[str], where: list[Pred]) -> Metric:
    """A window around a named day, where nothing selects dates, is a plain range of days: it shares scans with other metrics."""

    def settle(b: Base) -> Base:
        if b.window is None or b.window[2] is None:
            return b
        name, date, last = b.window
        if date in b.ignore or any(split_ref(r)[0] == date for r in [*by, *(r for p in where for r in p.refs)]):
            return b
        return dataclasses.replace(b, window=None, ignore=b.ignore | {date}, where=(*b.where, between(f"{date}.Datum", *_window_days(name, last))))

    return rewrite(metric, settle)


class _Frame:
    """All bases that share one fact scan, one set of joins and one grouping."""

    def __init__(self, model: Model, members: list[Base], by: list[str], filters: list[Pred]):
        self.model = model
        self.members = members
        head = members[0]
        self.head, self.fact = head, head.table
        self.paths: dict[str, list[Relationship]] = {}
        self.by = [r for r in by if self.applies(r) and r not in head.over]
        self.filters = [p for p in filters if all(self.applies(r) for r in p.refs)]
        # a window replaces the choice of dates; what is chosen only tells which days each group sees
        date = head.window[1] if head.window else None
        self.date = date if date and date not in head.ignore and self.path(date) else None
        self.seen = [p for p in self.filters if p.tables() == {self.date}]
        self.filters = [p for p in self.filters if p not in self.seen]
        self.restrictions = self._restrictions(filters)

    def _restrictions(self, filters: list[Pred]) -> dict[Route, tuple[Pred, ...]]:
        """Filters that reach this fact over semi and both relations only, by the way they take."""
        found: dict[Route, tuple[Pred, ...]] = {}
        for p in filters:
            ignored = any(split_ref(r)[0] in self.head.ignore and r not in self.head.keep for r in p.refs)
            if ignored or all(self.path(t) is not None for t in p.tables()):
                continue
            route = self.model.carriers(self.fact, p.tables(), self.head.without)
            if route:
                found[route] = (*found.get(route, ()), p)
        return found

    def _restricted(self, df: DataFrame, joins: Sequence[Relationship] = ()) -> DataFrame:
        """The fact's rows that the filtered tables keep, one semi-join per step of the way, and those that ``treat`` keeps.

        A key with very many rows is split (``on_key``), also where the next step goes over the same key.
        """
        for route, preds in self.restrictions.items():
            here, column = route[0]
            holder, key = split_ref(here)
            kept = _Frame(self.model, [Base(holder, "rows")], [], list(preds)).rows_of(key)
            for step, (table, own) in enumerate((split_ref(there) for _, there in route), 1):
                rows = df if step == len(route) else self.model.table(table)
                rows = on_key(rows, kept.select(F.col("_key").alias("_held")), {own: "_held"}, "left_semi", step)
                if step < len(route):
                    kept = rows.select(F.col(f"`{split_ref(route[step][0])[1]}`").alias("_key"))
            df = rows
        for source, target in self.head.treat:
            if any(j.pair == (source, target) for j in joins):
                continue  # that lookup drops the rows itself
            table, key = split_ref(target)
            own = F.col(f"`{split_ref(source)[1]}`")
            own = F.to_date(own) if table in self.model.date_tables and key == "Datum" else own
            df = df.join(self.model.table(table).select(F.col(f"`{key}`").alias("_held")), own == F.col("_held"), "left_semi")
        return df

    def rows_of(self, key: str) -> DataFrame:
        """A column of the fact as ``_key``, of the rows that pass the filters."""
        refs = {r for p in self.filters for r in p.refs}
        joins = self._joins({split_ref(r)[0] for r in refs} - {self.fact})
        own = {r for r in refs if split_ref(r)[0] == self.fact} | {j.source for j in joins if split_ref(j.source)[0] == self.fact}
        df = self.model.table(self.fact)
        df = df.select(F.col(f"`{key}`").alias("_own"), *[F.col(f"`{split_ref(r)[1]}`").alias(r) for r in sorted(own)])
        df = self._join_plain(df, joins, refs)
        return df.filter(_all([p.build(*[_q(r) for r in p.refs]) for p in self.filters])).select(F.col("_own").alias("_key"))

    def _join_plain(self, df: DataFrame, joins: list[Relationship], refs: set[str]) -> DataFrame:
        for step in joins:
            target, key = split_ref(step.target)
            wanted = {r for r in refs | {j.source for j in joins} if split_ref(r)[0] == target}
            dim = self.model.table(target).select(F.col(f"`{key}`").alias("_key"), *[F.col(f"`{split_ref(r)[1]}`").alias(r) for r in sorted(wanted)])
            source = F.to_date(_q(step.source)) if target in self.model.date_tables and key == "Datum" else _q(step.source)
            df = df.join(dim, source == F.col("_key"), "left").drop("_key")
        return df

    def path(self, table: str) -> list[Relationship] | None:
        if table == self.fact:
            return []
        if table not in self.paths:
            self.paths[table] = self.model.path(self.fact, table, self.head.via, self.head.without, self.head.treat)
        return self.paths[table]

    def applies(self, ref: str) -> bool:
        """An outer filter or grouping reaches this fact and is not ignored."""
        table = split_ref(ref)[0]
        if table in self.head.ignore and ref not in self.head.keep:
            return False
        return self.path(table) is not None

    # -- predicates ---------------------------------------------------------

    def _date_source(self, pred: Pred) -> str | None:
        """Own date column of the fact, when the predicate is a range of its date key."""
        if pred.days is None:
            return None
        table, _ = split_ref(pred.refs[0])
        path = self.path(table)
        if table in self.model.date_tables and path and len(path) == 1 and path[0].target == pred.refs[0]:
            return path[0].source
        return None

    def needs_lookup(self, pred: Pred) -> bool:
        """Can the predicate not be told from fact columns alone?"""
        return pred.tables() != {self.fact} and self._date_source(pred) is None

    def joins_date(self) -> bool:
        """Does any grouping or predicate need the date dimension itself?"""
        refs = set(self.by)
        for p in self.filters + [p for b in self.members for p in b.where]:
            if self.needs_lookup(p):
                refs.update(p.refs)
        needed = [step for r in refs for step in self.path(split_ref(r)[0]) or []]
        return any(split_ref(step.target)[0] in self.model.date_tables for step in needed)

    def on_fact(self, pred: Pred, shift: int | None = None) -> Column:
        """A predicate that needs no lookup, over fact columns."""
        shift = self.head.shift if shift is None else shift
        source = self._date_source(pred)
        if source is not None and shift:
            return pred.build(self._shifted(source, shift))
        span = self.span(pred, shift)
        return self._range(*span) if span is not None else pred.build(*[_q(r) for r in pred.refs])

    def span(self, pred: Pred, shift: int | None = None) -> Span | None:
        """Range of the raw date column that holds every row the predicate keeps.

        Exact without a shift, a little wider with one.
        """
        shift = self.head.shift if shift is None else shift
        if pred.days is None or len(pred.refs) != 1:
            return None
        low, high = pred.days
        if pred.tables() == {self.fact}:
            return pred.refs[0], low, high
        source = self._date_source(pred)
        if source is None:
            return None
        if shift:
            low = _months_before(low, shift + 1) if low else None
            high = _months_before(high, shift - 2) if high else None
        return source, low, high

    def scan_range(self) -> Column | None:
        """One range around the dates of all members: the scan can skip files by it."""
        spans = []
        for b in self.members:
            own = [s for s in (self.span(p, b.shift) for p in b.where) if s is not None]
            if not own:
                return None
            spans.append(own[0])
        lows, highs = [s[1] for s in spans], [s[2] for s in spans]
        if len({s[0] for s in spans}) != 1 or (None in lows and None in highs):
            return None
        return self._range(spans[0][0], None if None in lows else min(lows), None if None in highs else max(highs))

    @staticmethod
    def _range(ref: str, low: dt.date | None, high: dt.date | None) -> Column:
        tests = []
        if low is not None:
            tests.append(_q(ref) >= F.lit(low))
        if high is not None:
            tests.append(_q(ref) < F.lit(high + dt.timedelta(days=1)))
        return _all(tests)

    @staticmethod
    def _shifted(ref: str, shift: int) -> Column:
        day = F.to_date(_q(ref))
        return F.add_months(day, shift) if shift else day

    # -- windows -------------------------------------------------------------

    def _readers(self, key: str, wanted: set[str]) -> DataFrame:
        """(_key, grouping): every day's key with every group of dates that reads this day.

        As long as the calendar times the days a group reads; a month is read by 12 groups of months at most. Further
        columns are the day's own.
        """
        calendar = self.model.table(self.date)
        by = [r for r in self.by if split_ref(r)[0] == self.date]
        own = sorted(r for r in wanted if r not in by)
        named = calendar.select(F.col("Datum").alias("_own"), *[F.col(f"`{split_ref(r)[1]}`").alias(r) for r in sorted({*by, *(r for p in self.seen for r in p.refs)})])
        if self.seen:
            named = named.filter(_all([p.build(*[_q(r) for r in p.refs]) for p in self.seen]))
        groups = named.groupBy(*[_q(r) for r in by]).agg(F.max(F.to_date("_own")).alias("_last"))
        name, _, end = self.head.window
        if end is not None and not by and not self.seen:
            groups = groups.select(F.lit(end).alias("_last"))
        first, last = WINDOWS[name](F.col("_last"))
        read = groups.select(*[_q(r) for r in by], F.explode(F.sequence(first, last)).alias("_day_read"))
        days = calendar.select(F.to_date("Datum").alias("_own"), F.col(f"`{key}`").alias("_key"), *[F.col(f"`{split_ref(r)[1]}`").alias(r) for r in own])
        return read.join(days, F.col("_day_read") == F.col("_own")).select("_key", *[_q(r) for r in by], *[_q(r) for r in own])

    def _check_window(self) -> None:
        clash = {r for b in self.members for p in b.where if self.needs_lookup(p) for r in p.refs} & set(self.by)
        if self.date and any(split_ref(r)[0] == self.date for r in clash):
            raise ValueError(f"a windowed metric cannot be filtered and grouped by {sorted(clash)} at once: the one is a row's own, the other the reader's")

    # -- plan ----------------------------------------------------------------

    def refs_needed(self) -> set[str]:
        refs = set(self.by)
        for p in self.filters:
            if self._date_source(p) is None:
                refs.update(p.refs)
        for b in self.members:
            refs.update(r for r in (b.column, b.times, b.each) if r)
            for p in b.where:
                if self._date_source(p) is None:
                    refs.update(p.refs)
        return refs

    def build(self, names: dict[Base, str], sets: list[list[str]] | None) -> DataFrame:
        refs = self.refs_needed()
        self._check_window()
        joins = self._joins({split_ref(r)[0] for r in refs} - {self.fact} | ({self.date} if self.date else set()))
        fact_refs = {r for r in refs if split_ref(r)[0] == self.fact}
        fact_refs |= {j.source for j in joins if split_ref(j.source)[0] == self.fact}
        for p in self.filters + [p for b in self.members for p in b.where]:
            source = self._date_source(p)
            if source is not None:
                fact_refs.add(source)
        df = self._restricted(self.model.table(self.fact), joins)
        df = df.select(*[F.col(f"`{split_ref(r)[1]}`").alias(r) for r in sorted(fact_refs)])

        spans = [self._range(*span) for span in (self.span(p) for p in self.filters) if span is not None]
        around = self.scan_range()
        if around is not None:
            spans.append(around)
        if spans:
            df = df.filter(_all(spans))
        own = [self.on_fact(p) for p in self.filters if not self.needs_lookup(p)]
        if own:
            df = df.filter(_all(own))
        own_by_member = {
            b: [self.on_fact(p, b.shift) for p in b.where if not self.needs_lookup(p)] for b in self.members
        }
        if all(own_by_member.values()):
            df = df.filter(_any([_all(c) for c in own_by_member.values()]))

        df, values = self._join(df, joins, refs, self._values(own_by_member))

        outer = [p for p in self.filters if self.needs_lookup(p)]
        if outer:
            df = df.filter(_all([p.build(*[_q(r) for r in p.refs]) for p in outer]))
        looked_up = {
            b: [p.build(*[_q(r) for r in p.refs]) for p in b.where if self.needs_lookup(p)]
            for b in self.members
        }
        if all(looked_up.values()):
            df = df.filter(_any([_all(c) for c in looked_up.values()]))

        if self.head.each:
            return self._sum_of_max(df, names, looked_up, values)
        aggregates = [
            self._final(b, i, _all(looked_up[b]), values).alias(names[b]) for i, b in enumerate(self.members)
        ]
        if sets is None:
            return df.groupBy(*[_q(r) for r in self.by]).agg(*aggregates)
        own_sets = [[_q(r) for r in s if r in self.by] for s in sets]
        grouped = df.groupingSets(own_sets, *[_q(r) for r in self.by])
        return grouped.agg(F.bit_count(F.grouping_id()).alias(LEVEL), *aggregates)

    @property
    def alone(self) -> bool:
        """Must every grouping set be evaluated by itself? A coarser set is no sum over the finer one's rows here."""
        return bool(self.head.each or self.date)

    def _sum_of_max(self, df, names, looked_up, values) -> DataFrame:
        """Highest value per inner member first, then their sum per group."""
        keys, inner = [_q(r) for r in self.by], [_q(r) for r in dict.fromkeys([*self.by, self.head.each])]
        highest = df.groupBy(*inner).agg(
            *[F.max(_when(_all(looked_up[b]), values[f"p{i}"])).alias(names[b]) for i, b in enumerate(self.members)]
        )
        return highest.groupBy(*keys).agg(*[F.sum(names[b]).alias(names[b]) for b in self.members])

    def _joins(self, tables: set[str]) -> list[Relationship]:
        ordered: list[Relationship] = []
        reached = {self.fact}
        for table in sorted(tables):
            path = self.path(table)
            if path is None:
                raise ValueError(f"{self.fact} has no relationship that leads to {table}")
            for step in path:
                target = split_ref(step.target)[0]
                if target not in reached:
                    reached.add(target)
                    ordered.append(step)
        return ordered

    @property
    def foreign(self) -> bool:
        """Does a value come from a dimension instead of the fact?"""
        return any(b.column and split_ref(b.column)[0] != self.fact for b in self.members)

    def _values(self, own_by_member: dict[Base, list[Column]]) -> dict[str, Column]:
        """One value per metric (two for an average), empty where the row does not count.

        They are expressions over fact columns: plain rows carry only those
        columns through the lookups, however many metrics are computed from them.
        """
        values: dict[str, Column] = {}
        for i, b in enumerate(self.members):
            test = _all(own_by_member[b])
            own = b.column is not None and split_ref(b.column)[0] == self.fact
            if b.kind == "distinct":
                values[f"p{i}"] = _when(test, F.lit(1))
            elif b.kind in ("count", "rows"):
                one = F.when(_q(b.column).isNotNull(), F.lit(1)) if own and b.kind == "count" else F.lit(1)
                values[f"p{i}"] = _when(test, one.cast("long"))
            else:
                values[f"p{i}"] = _when(test, _q(b.column) if own else F.lit(1))
                if b.kind == "avg":
                    values[f"n{i}"] = F.when(values[f"p{i}"].isNotNull(), F.lit(1).cast("long"))
        return values

    def _subtotal(self, df: DataFrame, key: str, values: dict[str, Column]) -> tuple[DataFrame, dict[str, Column]]:
        folds = {"max": F.max, "sum_of_max": F.max, "distinct": F.max, "min": F.min}
        parts = [
            (F.sum if name[0] == "n" else folds.get(self.members[int(name[1:])].kind, F.sum))(value).alias(name)
            for name, value in values.items()
        ]
        return df.groupBy(_q(key)).agg(*parts), {name: F.col(name) for name in values}

    def _used_after_joins(self) -> set[str]:
        used = set(self.by)
        for p in self.filters + [p for b in self.members for p in b.where]:
            if self.needs_lookup(p):
                used.update(p.refs)
        for b in self.members:
            used.update(r for r in (b.times, b.each) if r)
            if b.column and (b.kind == "distinct" or split_ref(b.column)[0] != self.fact):
                used.add(b.column)
        return used

    def _join(
        self, df: DataFrame, joins: list[Relationship], refs: set[str], values: dict[str, Column]
    ) -> tuple[DataFrame, dict[str, Column]]:
        """Look the dimensions up one after the other.

        Rows are added up per key before a lookup, if that key is all that is
        still needed of them: they are then shuffled by it once, already added
        up, the lookup needs no shuffle of its own, and a hot key arrives as one
        row per task. With more columns still needed there is little to add up,
        and the lookup works on plain rows.
        """
        used = self._used_after_joins()
        for at, step in enumerate(joins):
            target, key = split_ref(step.target)
            wanted = {split_ref(r)[1] for r in refs if split_ref(r)[0] == target}
            wanted |= {split_ref(j.source)[1] for j in joins if split_ref(j.source)[0] == target}
            if target == self.date:
                dim = self._readers(key, {f"{target}.{c}" for c in wanted})
            else:
                dim = self.model.table(target).select(
                    F.col(f"`{key}`").alias("_key"),
                    *[F.col(f"`{c}`").alias(f"{target}.{c}") for c in sorted(wanted)],
                )
            source = step.source
            later = used | {j.source for j in joins[at + 1 :]}
            needed = {r for r in later | {source} if r in df.columns}
            if target in self.model.date_tables and key == "Datum":
                df = df.withColumn("_day", self._shifted(source, self.head.shift))
                needed, source = (needed if source in later else needed - {source}) | {"_day"}, "_day"
            if needed == {source} and not self.foreign:
                df, values = self._subtotal(df, source, values)
            df = df.join(dim, _q(source) == F.col("_key"), "inner" if target == self.date or step.pair in self.head.treat else "left").drop("_key", "_day")
        return df, values

    def _final(self, b: Base, i: int, test: Column | None, values: dict[str, Column]) -> Column:
        p = values[f"p{i}"]
        if b.column and split_ref(b.column)[0] != self.fact and b.kind != "distinct":
            # the value itself lives on a dimension; p marks the rows that count
            p = F.when(p.isNotNull(), _q(b.column))
        if b.kind == "distinct":
            counted = F.lit(True) if test is None else test
            marked = counted & p.isNotNull()
            column = F.to_date(_q(b.column)) if b.days else _q(b.column)
            n = F.count_distinct(F.when(marked, column)) + F.coalesce(
                F.max(F.when(marked & column.isNull(), F.lit(1))), F.lit(0)
            )
            return F.nullif(n.cast("long"), F.lit(0).cast("long"))
        if b.times:
            p = p * _q(b.times)
        value = _when(test, p)
        if b.kind in ("count", "rows"):
            if b.column and split_ref(b.column)[0] != self.fact:
                value = F.when(value.isNotNull(), F.lit(1).cast("long"))
            return F.nullif(F.sum(value), F.lit(0).cast("long"))
        if b.kind == "avg":
            return F.try_divide(F.sum(value), F.sum(_when(test, values[f"n{i}"])))
        return {"sum": F.sum, "max": F.max, "min": F.min}[b.kind](value)


def _tables_of(b: Base) -> set[str]:
    refs = [r for r in (b.column, b.times, b.each) if r] + [r for p in b.where for r in p.refs]
    return {split_ref(r)[0] for r in refs}


def _frames(model: Model, wanted: list[Base], by: list[str], where: list[Pred]) -> list[_Frame]:
    """As few fact scans as possible: bases share one when they see the same
    grouping, filters and lookups, whatever choices led there."""
    outer = {split_ref(r)[0] for r in by} | {t for p in where for t in p.tables()}
    groups: dict[tuple, list[Base]] = {}
    for fact in dict.fromkeys(b.table for b in wanted):
        own = [b for b in wanted if b.table == fact]
        tables = sorted(outer | {t for b in own for t in _tables_of(b)})
        alone = {b: _Frame(model, [b], by, where) for b in own}
        dated = any(f.joins_date() for f in alone.values())
        for b, frame in alone.items():
            paths = tuple(tuple(p) if (p := frame.path(t)) is not None else None for t in tables)
            distinct = (b.column, b.days) if b.kind == "distinct" else None
            key = (fact, tuple(frame.by), tuple(frame.filters), tuple(frame.restrictions.items()), paths, distinct, b.each, b.shift if dated else None, b.treat, frame.date and b.window, tuple(frame.seen))
            groups.setdefault(key, []).append(b)
    return [_Frame(model, members, by, where) for members in groups.values()]


def _result(metric: Metric, names: dict[Base, str]) -> Column:
    if isinstance(metric, Base):
        return F.col(names[metric])
    return metric.combine(*[_result(p, names) for p in metric.parts])


def evaluate(
    model: Model,
    metrics: dict[str, Metric],
    by: Sequence[str] = (),
    where: Sequence[Pred] = (),
    totals: bool | str = False,
    sort: Sequence[tuple[str, bool]] = (),
    keep_empty: bool = False,
) -> DataFrame:
    """One row per member of the grouping with every metric as a column.

    ``by`` holds ``"Table.Column"`` references and becomes columns of the bare
    column names. ``totals=True`` adds a re-evaluated grand total and
    ``totals="rollup"`` every prefix of the grouping; the column
    ``grouping_level`` then counts the columns aggregated away. Members for
    which every metric is empty are left out unless ``keep_empty``. A filter that
    no relation carries to any fact has no effect and is reported as a warning.
    """
    by = list(by)
    metrics = {n: _settled(x, by, list(where)) for n, x in metrics.items()}
    wanted: list[Base] = list(dict.fromkeys(b for m in metrics.values() for b in bases(m)))
    names = {b: f"_m{i}" for i, b in enumerate(wanted)}
    sets = None
    if totals == "rollup":
        sets = [by[:n] for n in range(len(by), -1, -1)]
    elif totals:
        sets = [by, []]

    frames = _frames(model, wanted, by, list(where))
    _report(frames, list(where))
    full, partial = [], []
    for frame in frames:
        own = [names[b] for b in frame.members]
        if frame.by == by and not (sets and frame.alone):
            full.append((frame.build(names, sets), own))
        elif sets is not None and frame.by:
            levels = _by_set(model, frame, by, list(where), sets, names)
            if frame.by == by:
                full.append((levels, own))
            else:
                partial.append((levels, [*frame.by, LEVEL], own))
        else:
            partial.append((frame.build(names, None), frame.by, own))

    keys = by + ([LEVEL] if sets is not None else [])
    result = _drill_across([f for f, _ in full], keys)
    if result is None:
        result = _grid(model, by, list(where), sets, partial)
    for df, own_by, own in partial:
        result = _attach(result, df, own_by, own)

    columns = [_result(m, names).alias(n) for n, m in metrics.items()]
    lead = [_q(r).alias(split_ref(r)[1]) for r in by] + ([F.col(LEVEL)] if sets is not None else [])
    out = result.select(*lead, *columns)
    measured = [n for n, m in metrics.items() if bases(m)]
    if by and measured and not keep_empty:
        out = out.filter(_any([F.col(f"`{n}`").isNotNull() for n in measured]))
    if sort:
        out = out.orderBy(
            *[F.col(f"`{c}`").asc_nulls_first() if up else F.col(f"`{c}`").desc_nulls_last() for c, up in sort]
        )
    return out


def _drill_across(frames: list[DataFrame], keys: list[str]) -> DataFrame | None:
    """Bring aggregated facts together: stack them, then one row per key."""
    if not frames:
        return None
    if len(frames) == 1:
        return frames[0]
    stacked = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    values = [c for c in stacked.columns if c not in keys]
    return stacked.groupBy(*[_q(k) for k in keys]).agg(*[F.max(c).alias(c) for c in values])


def _by_set(
    model: Model, frame: _Frame, by: list[str], where: list[Pred], sets: list[list[str]], names: dict[Base, str]
) -> DataFrame:
    """The metrics of a frame for each grouping set by itself, with its level; columns that a set leaves out are empty."""
    parts = []
    for s in sets:
        part = _Frame(model, frame.members, s, where)
        columns = [_q(r) if r in part.by else F.lit(None).alias(r) for r in frame.by]
        parts.append(part.build(names, None).select(*columns, *[names[b] for b in frame.members], F.lit(len(by) - len(s)).cast("int").alias(LEVEL)))
    return functools.reduce(lambda a, b: a.unionByName(b), parts)


def _report(frames: list[_Frame], where: list[Pred]) -> None:
    """Warn of filters that no relation carries to any fact."""
    for p in where:
        used = any(p in f.filters or p in f.seen or any(p in ps for ps in f.restrictions.values()) for f in frames)
        meant = any(not f.head.ignore & p.tables() for f in frames)
        if meant and not used:
            warnings.warn(f"no relation carries the filter {p.text} to any fact: it has no effect", stacklevel=3)


def _grid(
    model: Model, by: list[str], where: list[Pred], sets: list[list[str]] | None, partial: list[tuple[DataFrame, list[str], list[str]]]
) -> DataFrame:
    """The combinations to show where no metric uses the whole grouping: each table's visible members with each other's.

    A metric that ignores a table shows with every member of it, so the answer is this product. The members of the first table
    are rows; those of each other one come as an array, which has no more entries than the answer has rows.
    """
    if not by:
        raise ValueError("nothing to evaluate")
    grid = None
    for table in dict.fromkeys(split_ref(r)[0] for r in by):
        refs = [r for r in by if split_ref(r)[0] == table]
        tests = [p for p in where if p.tables() == {table}]
        needed = sorted({*refs, *(r for p in tests for r in p.refs)})
        source = model.table(table).select(*[F.col(f"`{split_ref(r)[1]}`").alias(r) for r in needed])
        if tests:
            source = source.filter(_all([p.build(*[_q(r) for r in p.refs]) for p in tests]))
        found = source.select(*[_q(r) for r in refs])
        for df, own_by, _ in partial:  # members that only the facts have, such as the empty one
            if set(refs) <= set(own_by):
                rows = df.where(F.col(LEVEL) == 0) if LEVEL in own_by else df
                found = found.unionByName(rows.select(*[_q(r) for r in refs]))
        found = found.distinct()
        if grid is None:
            grid = found
        else:
            every = found.agg(F.collect_list(F.struct(*[_q(r) for r in refs])).alias("_every")).scalar()
            grid = grid.withColumn("_every", every).withColumn("_one", F.explode("_every"))
            grid = grid.select(*[_q(c) for c in grid.columns if c not in ("_every", "_one")], *[F.col(f"_one.`{r}`").alias(r) for r in refs])
    if sets is None:
        return grid
    levels = []
    for s in sets:
        rows = grid.select(*[_q(r) for r in s]).distinct() if s else model.table(split_ref(by[0])[0]).agg(F.count("*").alias("_n"))
        levels.append(rows.select(*[_q(r) if r in s else F.lit(None).alias(r) for r in by], F.lit(len(by) - len(s)).cast("int").alias(LEVEL)))
    return functools.reduce(lambda a, b: a.unionByName(b), levels)


def _attach(grid: DataFrame, df: DataFrame, own_by: list[str], own: list[str]) -> DataFrame:
    """Repeat a metric that is constant over part of the grouping."""
    if not own_by:
        # a single row: read it once as a scalar value
        row = df.select(F.struct(*own).alias("_row")).scalar()
        grid = grid.withColumn("_row", row)
        return grid.select("*", *[F.col(f"_row.{c}").alias(c) for c in own]).drop("_row")
    renamed = df.select(*[_q(r).alias(f"_k{i}") for i, r in enumerate(own_by)], *own)
    on = _all([_q(r).eqNullSafe(F.col(f"_k{i}")) for i, r in enumerate(own_by)])
    return grid.join(renamed, on, "left").drop(*[f"_k{i}" for i in range(len(own_by))])
