"""Forward fill of short gaps, without putting a station's whole history into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def forward_fill(
    df: DataFrame, measures: Sequence[str], limit: int = 2, entity: str = "station_id", ts: str = "observation_ts",
) -> DataFrame:
    """Replace runs of at most ``limit`` consecutive NULLs by the value before the run.

    Longer runs, and those with nothing before them, stay.  Rows are handled per entity and day; what
    crosses midnight is settled on a table with one row per entity and day, and joined back.  The
    result has ``<measure>_filled`` next to each measure.
    """
    day = "_day"
    # Rows have a key and an instant; saying so here lets both uses below share one shuffle.
    rows = df.withColumn(day, F.col(ts).cast("date")).filter(F.col(entity).isNotNull() & F.col(day).isNotNull())
    whole = Window.partitionBy(entity, day)
    in_order = whole.orderBy(ts)
    running = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    # Island of a row within its day: number of values so far, 0 for the nulls before the first.
    local = rows.withColumns({f"_i_{m}": F.count(m).over(running) for m in measures})
    local = local.withColumns({f"_n_{m}": F.count(m).over(whole) for m in measures})
    local = local.withColumns({
        name: expr for m in measures for name, expr in {
            f"_b_{m}": F.max(m).over(Window.partitionBy(entity, day, f"_i_{m}")),
            f"_g_{m}": F.count_if(F.col(m).isNull()).over(Window.partitionBy(entity, day, f"_i_{m}")),
        }.items()
    })

    # One row per day: values, nulls before the first and after the last value, and that last value.
    is_last = {m: F.col(f"_i_{m}") == F.col(f"_n_{m}") for m in measures}
    days = local.groupBy(entity, day).agg(*[
        e for m in measures for e in (
            F.max(f"_n_{m}").alias(f"_n_{m}"),
            F.max(F.when(F.col(f"_i_{m}") == 0, F.col(f"_g_{m}"))).alias(f"_lead_{m}"),
            F.max(F.when(is_last[m], F.col(f"_g_{m}"))).alias(f"_tail_{m}"),
            F.max(F.when(is_last[m], F.col(f"_b_{m}"))).alias(f"_last_{m}"),
        )
    ])
    across = _cross_day_gaps(days, measures, entity, day)

    joined = local.join(across, [entity, day])
    return joined.select(*df.columns, *[_filled(m, limit).alias(f"{m}_filled") for m in measures])


def _cross_day_gaps(days: DataFrame, measures: Sequence[str], entity: str, day: str) -> DataFrame:
    """Base value and total length of the gap entering and leaving every day."""
    forward, backward = Window.partitionBy(entity).orderBy(day), Window.partitionBy(entity).orderBy(F.col(day).desc())
    earlier = backward.rowsBetween(Window.unboundedPreceding, -1)
    out = days
    for m in measures:
        has_value = F.col(f"_n_{m}") > 0
        # A day with values opens the island of the nulls after its last one; empty days prolong it.
        out = out.withColumns({
            f"_isl_{m}": F.count(F.when(has_value, 1)).over(forward),
            f"_next_{m}": F.last(F.when(has_value, F.coalesce(f"_lead_{m}", F.lit(0))), True).over(earlier),
        })
        island = Window.partitionBy(entity, f"_isl_{m}")
        out = out.withColumns({
            f"_ob_{m}": F.max(F.when(has_value, F.col(f"_last_{m}"))).over(island),
            f"_og_{m}": F.sum(f"_tail_{m}").over(island) + F.coalesce(f"_next_{m}", F.lit(0)),
        })
        out = out.withColumns({
            f"_ib_{m}": F.when(has_value, F.lag(f"_ob_{m}").over(forward)).otherwise(F.col(f"_ob_{m}")),
            f"_ig_{m}": F.when(has_value, F.lag(f"_og_{m}").over(forward)).otherwise(F.col(f"_og_{m}")),
        })
    return out.select(entity, day, *[f"_{k}_{m}" for m in measures for k in ("ib", "ig", "og")])


def _filled(m: str, limit: int) -> Column:
    value, island = F.col(m), F.col(f"_i_{m}")
    incoming = F.when(F.col(f"_ig_{m}") <= limit, F.col(f"_ib_{m}"))
    gap = F.when(island == F.col(f"_n_{m}"), F.col(f"_og_{m}")).otherwise(F.col(f"_g_{m}"))
    inside = F.when(gap <= limit, F.col(f"_b_{m}"))
    return F.coalesce(value, F.when(island == 0, incoming).otherwise(inside))
