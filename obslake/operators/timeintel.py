"""Date contexts: which days of the facts a context of the calendar reads.

A *context* is one combination of calendar attributes (a month, a season, an ENSO label ...); its key
columns are named apart from the calendar's own (see ``with_context_keys``).  Every
table built here has at most a few rows per calendar day, so it is bounded by the calendar's length
(see ``calendar.MAX_DAYS``) whatever the facts hold, and can be broadcast to them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

DAY = "date_local"


@dataclass(frozen=True)
class FilterContext:
    """A selection, as one condition per column that it is put on.

    ``entries`` maps a column to the values it may have (``None`` among them allows a missing one) or to a condition on it. A measure
    that sets a column itself replaces the entry of that column and keeps the others. ``fixed`` is a condition on any columns, which
    nothing replaces.
    """

    entries: Mapping[str, Column | Sequence] = field(default_factory=dict)
    fixed: Column | None = None

    @staticmethod
    def of(selection: "FilterContext | Mapping[str, Column | Sequence] | Column | None") -> "FilterContext":
        if selection is None or isinstance(selection, FilterContext):
            return selection or FilterContext()
        return FilterContext(fixed=selection) if isinstance(selection, Column) else FilterContext(dict(selection))

    def without(self, column: str) -> "FilterContext":
        """The same selection with the entry of ``column`` cleared."""
        return FilterContext({k: v for k, v in self.entries.items() if k != column}, self.fixed)

    def only(self, column: str) -> Column | None:
        """The condition on ``column``, if there is one."""
        return FilterContext({column: self.entries[column]}).condition() if column in self.entries else None

    def condition(self) -> Column | None:
        """All conditions together; ``None`` selects everything."""
        parts = [] if self.fixed is None else [self.fixed]
        for column, allowed in self.entries.items():
            if isinstance(allowed, Column):
                parts.append(allowed)
            else:
                values = [v for v in allowed if v is not None]
                listed = F.col(column).isin(values)
                parts.append(F.col(column).isNull() | listed if len(values) < len(list(allowed)) else listed)
        return reduce(lambda a, b: a & b, parts) if parts else None

    def apply(self, df: DataFrame) -> DataFrame:
        condition = self.condition()
        return df if condition is None else df.filter(condition)


def context_key(name: str) -> str:
    return f"_ctx_{name}"


def with_context_keys(calendar: DataFrame, keys: Sequence[str]) -> DataFrame:
    return calendar.withColumns({context_key(k): F.col(k) for k in keys}) if keys else calendar


def current_days(selected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Context and the selected days it consists of."""
    return selected.select(*keys, DAY)


def days_last_year(selected: DataFrame, calendar: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Context and the days one year before its own, as far as the calendar knows them.

    29 February falls on the 28th.  A context holding the last two days of a month reaches to the end of
    that month a year earlier, so that February of a year after a leap year compares with 29 days.
    """
    own = current_days(selected, keys)
    shifted = own.withColumn(DAY, F.add_months(DAY, -12))
    month_end = (
        own.filter(F.col(DAY) >= F.date_sub(F.last_day(DAY), 1))
        .groupBy(*keys, F.last_day(DAY).alias("_end")).agg(F.count("*").alias("_n"))
        .filter(F.col("_n") == 2).select(*keys, F.last_day(F.add_months("_end", -12)).alias(DAY))
    )
    known = calendar.select(DAY).distinct()
    return shifted.unionByName(month_end).distinct().join(F.broadcast(known), DAY, "left_semi").select(*keys, DAY)


def override_days(selected: DataFrame, free: DataFrame, keys: Sequence[str], column: str, value: int) -> DataFrame:
    """Days of each context with every condition on ``column`` replaced by ``column = value``.

    ``selected`` gives the contexts; ``free`` are the days with the selection on ``column`` cleared. A context keyed on
    ``column`` itself reads the days of its other keys.
    """
    wanted = free.filter(F.col(column) == value)
    key = context_key(column)
    if not keys:
        return current_days(wanted, keys)
    existing = selected.select(*keys).distinct()
    if key in keys:
        wanted = wanted.withColumn(key, F.explode(selected.agg(F.collect_set(key)).scalar()))
    same = [F.col(f"_w.{k}").eqNullSafe(F.col(f"_x.{k}")) for k in keys]
    return wanted.alias("_w").join(F.broadcast(existing.alias("_x")), reduce(lambda x, y: x & y, same), "left_semi").select(*keys, DAY)


def bridge(roles: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """One row per context and day, with a flag per role the day plays in the context."""
    tagged: DataFrame | None = None
    for role, days in roles.items():
        part = days.select(*keys, DAY, *[F.lit(r == role).alias(f"in_{r}") for r in roles])
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.groupBy(*keys, DAY).agg(*[F.bool_or(f"in_{r}").alias(f"in_{r}") for r in roles])


def last_days(selected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last day of every context."""
    return selected.groupBy(*keys).agg(F.max(DAY).alias("_last"))


def _ends_of_year(lasts: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """For each year its context ends in order, each with the columns ``carried``; bounded by the calendar."""
    ends = lasts.select(F.year("_last").alias("_year"), F.struct(F.col("_last").alias("end"), *carried).alias("_end")).distinct()
    return ends.groupBy("_year").agg(F.sort_array(F.collect_list("_end")).alias("_ends"))


def _spread(running: DataFrame, ends: DataFrame) -> DataFrame:
    """Each running total at the ends that it holds for: from its own up to the next of the entity (``_until``)."""
    reached = F.filter("_ends", lambda e: (e["end"] >= F.col("_own")) & F.coalesce(e["end"] < F.col("_until"), F.lit(True)))
    return running.withColumn("_year", F.year("_own")).join(F.broadcast(ends), "_year").withColumn("_end", F.explode(reached))


def year_to_date(
    facts: DataFrame, calendar: DataFrame, lasts: DataFrame, entity: Sequence[str], keys: Sequence[str], states: dict[str, Column],
) -> DataFrame:
    """Totals of additive states from 1 January to the end of each context: a row per entity and context that has any.

    Days are first cut into segments that end where some context ends, so the running window sees one row
    per entity and segment (at most 366 a year) and never the facts themselves. Contexts may lie anywhere in the
    calendar, and an entity's total holds for contexts after its last fact of the year.
    """
    ends = lasts.select(F.col("_last").alias(DAY)).distinct().withColumn("_is_end", F.lit(True))
    later_first = Window.partitionBy(F.year(DAY)).orderBy(F.col(DAY).desc())
    segment = (
        calendar.select(DAY).distinct().join(F.broadcast(ends), DAY, "left")
        .withColumn("_segment", F.last(F.when(F.col("_is_end"), F.col(DAY)), True).over(later_first))
        .filter(F.col("_segment").isNotNull()).select(DAY, "_segment")
    )
    per_segment = facts.join(F.broadcast(segment), DAY).groupBy(*entity, "_segment").agg(
        *[state.alias(name) for name, state in states.items()])
    in_year = Window.partitionBy(*entity, F.year("_segment")).orderBy("_segment")
    running = per_segment.select(
        *entity, F.col("_segment").alias("_own"), F.lead("_segment").over(in_year).alias("_until"),
        *[F.sum(name).over(in_year).alias(name) for name in states],
    )
    reached = _spread(running, _ends_of_year(lasts, keys))
    return reached.select(*entity, *[F.col(f"_end.{k}").alias(k) for k in keys], *states)


def running_within_year(out: DataFrame, lasts: DataFrame, entity: Sequence[str], keys: Sequence[str], states: dict[str, str]) -> DataFrame:
    """``out``, rows per entity and context, with running totals (``{name: column added up}``) of the year.

    For contexts that cut the year into stretches one after the other. Contexts of the year after an entity's first
    that it has no row for are added, with the total reached and nothing else.
    """
    with_ends = out.join(F.broadcast(lasts.withColumnsRenamed({k: f"_k_{k}" for k in keys})),
                         reduce(lambda a, b: a & b, [out[k] == F.col(f"_k_{k}") for k in keys])).drop(*[f"_k_{k}" for k in keys])
    in_year = Window.partitionBy(*entity, F.year("_last")).orderBy("_last")
    others = [c for c in out.columns if c not in (*entity, *keys)]
    running = with_ends.select(
        *entity, *others, F.col("_last").alias("_own"), F.lead("_last").over(in_year).alias("_until"),
        *[F.sum(c).over(in_year).alias(name) for name, c in states.items()])
    reached = _spread(running, _ends_of_year(lasts, keys))
    own = F.col("_end.end") == F.col("_own")
    rows = reached.select(*entity, *[F.col(f"_end.{k}").alias(k) for k in keys], own.alias("_is_own"),
                          *[F.when(own, F.col(c)).alias(c) for c in others], *states)
    some = reduce(lambda a, b: a | b, [F.col(name).isNotNull() for name in states])
    return rows.filter(F.col("_is_own") | some).drop("_is_own")
