"""Time frames over entities, written so that no entity has to fit in one task.

* Frames with a bounded look-back first combine the rows of one (entity, instant); this
  happens map-side, so an entity contributes at most one row per instant however many rows
  it has. The instants are laid out by (entity, time cell), and the tail of each cell is
  copied into the next one, so that a cell holds everything its own instants can see. The
  result is joined back on (entity, instant).
* Sums and counts over ``[t - start, t - end]`` are the difference of two growing frames:
  linear work, where a sliding frame would add up all its rows again for each row.
* Lags, running totals and as-of look-ups cut hot entities into cells (``skew``) and pass
  on what earlier cells left behind: one row per (hot entity, cell).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage
from .skew import CELL, ROWS_PER_TASK, cut_in_time, prefixed, same_keys

HALO = "_halo"


@dataclass(frozen=True)
class Stat:
    """One rolling measure over rows whose ``value`` is not null."""

    kind: str  # count | sum | avg | ratio | stddev | min | max
    value: Column


def _with_halo(df: DataFrame, time: str, lookback: int, cell: int | None) -> DataFrame:
    """Add the time cell; rows within ``lookback`` of the cell end are copied to the next cell."""
    width = max(cell or 4 * lookback, lookback, 1)
    home = F.floor(F.col(time) / F.lit(width)).cast("long")
    here = F.struct(home.alias(CELL), F.lit(False).alias(HALO))
    there = F.struct((home + 1).alias(CELL), F.lit(True).alias(HALO))
    seen_by_next = F.col(time) + F.lit(lookback) >= (home + 1) * F.lit(width)
    return df.select("*", F.inline(F.when(seen_by_next, F.array(here, there)).otherwise(F.array(here))))


def _partials(stats: Mapping[str, Stat]) -> list[Column]:
    """Per-instant pieces of every measure."""
    out = []
    for name, stat in stats.items():
        v = stat.value
        if stat.kind in ("min", "max"):
            out.append((F.min(v) if stat.kind == "min" else F.max(v)).alias("_s_" + name))
            continue
        out.append(F.count(v).alias("_n_" + name))
        if stat.kind in ("sum", "avg", "ratio"):
            out.append(F.sum(v).alias("_s_" + name))
        elif stat.kind == "stddev":
            out += [F.avg(v).alias("_s_" + name), (F.var_pop(v) * F.count(v)).alias("_q_" + name)]
        elif stat.kind != "count":
            raise ValueError(f"unknown rolling statistic {stat.kind!r}")
    return out


def _extreme(df: DataFrame, keys: Sequence[str], time: str, start: int, end: int, name: str, best: Callable) -> tuple[DataFrame, Column]:
    """Smallest or largest value of ``[t - start, t - end]``, in linear work.

    Time is cut into blocks as long as the frame, so a frame is one whole block or the end of one and the beginning of the next.
    The best value from each row to its block's end, and from its block's beginning to each row, answer both parts.
    """
    width = start - end + 1
    block, low, high = (f"_{x}_{name}" for x in ("b", "up", "down"))

    def block_of(at: Column) -> Column:
        return F.floor(at / F.lit(width))

    in_block = W.partitionBy(*keys, CELL, block)
    df = df.withColumn(block, block_of(F.col(time)))
    df = df.withColumns({
        low: best("_s_" + name).over(in_block.orderBy(time).rowsBetween(W.unboundedPreceding, 0)),
        high: best("_s_" + name).over(in_block.orderBy(F.desc(time)).rowsBetween(W.unboundedPreceding, 0))})
    in_cell = W.partitionBy(*keys, CELL)
    last = F.last(F.struct(block, low)).over(in_cell.orderBy(time).rangeBetween(W.unboundedPreceding, -end))
    first = F.last(F.struct(block, high)).over(in_cell.orderBy(F.desc(time)).rangeBetween(W.unboundedPreceding, start))
    parts = [F.when(last[block] == block_of(F.col(time) - end), last[low]), F.when(first[block] == block_of(F.col(time) - start), first[high])]
    return df, (F.least if best is F.min else F.greatest)(*parts)


def _framed(instants: DataFrame, keys: Sequence[str], time: str, start: int, end: int,
            stats: Mapping[str, Stat], cell: int | None) -> DataFrame:
    """Measures of every instant over ``[t - start, t - end]``."""
    in_cell = W.partitionBy(*keys, CELL)
    ordered = in_cell.orderBy(time)

    def grown(expr: Column) -> Column:
        upto_end = F.sum(expr).over(ordered.rangeBetween(W.unboundedPreceding, -end))
        before_start = F.sum(expr).over(ordered.rangeBetween(W.unboundedPreceding, -start - 1))
        return F.coalesce(upto_end, F.lit(0)) - F.coalesce(before_start, F.lit(0))

    out = _with_halo(instants, time, start, cell)
    # spread is summed about the cell mean, which keeps the subtraction well conditioned
    shifted = {"_s_" + n: F.col("_s_" + n) - F.avg("_s_" + n).over(in_cell) for n, s in stats.items() if s.kind == "stddev"}
    if shifted:
        out = out.withColumns(shifted)
    measures = {}
    for name, stat in stats.items():
        if stat.kind in ("min", "max"):
            out, measures[name] = _extreme(out, keys, time, start, end, name, F.min if stat.kind == "min" else F.max)
            continue
        n = grown(F.col("_n_" + name))
        s = F.col("_s_" + name)
        if stat.kind == "count":
            measures[name] = n
        elif stat.kind == "sum":
            measures[name] = F.when(n > 0, grown(s))
        elif stat.kind == "avg":
            measures[name] = F.when(n > 0, grown(s) / n)
        elif stat.kind == "ratio":
            measures[name] = F.when(n > 0, grown(s) / n).otherwise(F.lit(0.0))
        else:
            weight = F.col("_n_" + name)
            first = grown(weight * s)
            second = grown(F.col("_q_" + name) + weight * s * s)
            var = (second - first * first / n) / (n - 1)
            measures[name] = F.when(n > 1, F.sqrt(F.greatest(var, F.lit(0.0))))
    return out.withColumns(measures).filter(~F.col(HALO)).select(*keys, time, *stats)


def rolling(
    df: DataFrame, keys: Sequence[str], time: str, start: int, end: int,
    stats: Mapping[str, Stat], cell: int | None = None,
) -> DataFrame:
    """Add statistics over rows of the same keys with time in ``[t - start, t - end]``.

    ``time``, ``start`` and ``end`` share one integer unit. All rows at one instant see the
    same frame. To keep labels out of their own window, ``end`` must be at least the
    prediction horizon plus the delay until a label is known.
    """
    on = [*keys, time]
    instants = df.groupBy(*on).agg(*_partials(stats))
    framed = prefixed(_framed(instants, keys, time, start, end, stats, cell), on)
    return df.join(framed, same_keys(df, framed, on), "left").drop(*["_r_" + k for k in on])


def rolling_by_day(
    df: DataFrame, keys: Sequence[str], day: str, start: int, end: int, stats: Mapping[str, Stat],
) -> DataFrame:
    """Long windows in days over the daily table: a frame has at most ``start`` rows per entity.

    Supports count, sum and avg.
    """
    on = [*keys, day]
    daily = df.groupBy(*on).agg(*_partials(stats))
    frame = W.partitionBy(*keys).orderBy(day).rangeBetween(-start, -end)
    cols = {}
    for name, stat in stats.items():
        n = F.coalesce(F.sum("_n_" + name).over(frame), F.lit(0))
        if stat.kind == "count":
            cols[name] = n
        elif stat.kind in ("sum", "avg"):
            s = F.sum("_s_" + name).over(frame)
            cols[name] = F.when(n > 0, s if stat.kind == "sum" else s / n)
        else:
            raise ValueError(f"{stat.kind!r} is not a daily statistic")
    framed = prefixed(daily.withColumns(cols).select(*on, *stats), on)
    return df.join(framed, same_keys(df, framed, on), "left").drop(*["_r_" + k for k in on])


def preceding_stats(
    probes: DataFrame, events: DataFrame, keys: Sequence[str], probe_time: str, event_time: str,
    start: int, end: int, stats: Mapping[str, Stat], cell: int | None = None,
) -> DataFrame:
    """For each probe: statistics of ``events`` with equal keys and time in ``[t - start, t - end]``.

    Instants of both sides are laid out together, so events are never paired with probes.
    """
    moments = probes.select(*keys, F.col(probe_time).alias("_t")).distinct()
    happened = events.withColumn("_t", F.col(event_time)).groupBy(*keys, "_t").agg(*_partials(stats))
    both = moments.unionByName(happened, allowMissingColumns=True)
    pieces = [c for c in happened.columns if c not in (*keys, "_t")]
    merged = both.groupBy(*keys, "_t").agg(*[F.max(c).alias(c) for c in pieces])
    framed = prefixed(_framed(merged, keys, "_t", start, end, stats, cell), [*keys, "_t"])
    timed = probes.withColumn("_t", F.col(probe_time))
    out = timed.join(framed, same_keys(timed, framed, [*keys, "_t"]), "left")
    return out.select(*probes.columns, *stats)


def as_of(
    probes: DataFrame, observations: DataFrame, keys: Sequence[str], probe_time: str, obs_time: str,
    lookback: int, payload: Sequence[str], tie: str, limit: int = ROWS_PER_TASK,
) -> DataFrame:
    """Latest observation at or before each probe, at most ``lookback`` old.

    Both sides are laid out together and a running last value answers the probes: each
    probe comes out exactly once and is never paired with all observations of its look-back.
    Adds ``obs_time`` and ``payload`` columns, null when nothing qualifies.
    """
    seen = [obs_time, *[c for c in payload if c != obs_time]]
    p = probes.select(
        *keys, F.col(probe_time).cast("long").alias("_t"), F.lit(1).alias("_kind"), F.struct("*").alias("_probe"))
    o = observations.filter(F.col(obs_time).isNotNull()).select(
        *keys, F.col(obs_time).cast("long").alias("_t"), F.lit(0).alias("_kind"),
        F.col(tie).alias("_tie"), F.struct(*seen).alias("_obs"))
    both = cut_lineage(p.unionByName(o, allowMissingColumns=True))  # read by the count and by the cells
    cells, cut = cut_in_time(both, keys, "_t", limit)
    on = [*keys, CELL]
    run = W.partitionBy(*on).orderBy("_t", "_kind", "_tie").rowsBetween(W.unboundedPreceding, 0)
    found = cells.withColumn("_last", F.last("_obs", ignorenulls=True).over(run)).filter(F.col("_kind") == 1)
    if cut:
        newest = F.max_by("_obs", F.struct("_t", "_tie"))
        tails = cells.filter(F.col("_kind") == 0).groupBy(*on).agg(newest.alias("_tail"))
        found = _handed_on(found, _every_cell(cells, tails, on), on, "_tail", "_carry")
        found = found.withColumn("_last", F.coalesce("_last", "_carry"))
    fresh = F.col("_t") - F.col("_last." + obs_time) <= F.lit(lookback)
    return found.select("_probe.*", *[F.when(fresh, F.col("_last." + c)).alias(c) for c in seen])


def _every_cell(cells: DataFrame, tails: DataFrame, on: Sequence[str]) -> DataFrame:
    """Tails for all occupied cells, so that a cell without observations passes on the one before."""
    right = prefixed(tails, on)
    occupied = cells.select(*on).distinct()
    return occupied.join(right, same_keys(occupied, right, on), "left").drop(*["_r_" + k for k in on])


def _handed_on(df: DataFrame, tails: DataFrame, on: Sequence[str], tail: str, name: str) -> DataFrame:
    """Attach the last non-null tail of earlier cells. The table of tails has a row per cell."""
    earlier = W.partitionBy(*on[:-1]).orderBy(CELL).rowsBetween(W.unboundedPreceding, -1)
    carried = tails.select(*on, F.last(tail, ignorenulls=True).over(earlier).alias(name)).filter(F.col(name).isNotNull())
    right = prefixed(carried, on)
    return df.join(right, same_keys(df, right, on), "left").drop(*["_r_" + k for k in on])


def previous(
    df: DataFrame, keys: Sequence[str], time: str, tie: str, columns: Mapping[str, str], limit: int = ROWS_PER_TASK,
) -> DataFrame:
    """``lag`` per entity: output name -> source column, taken from the row just before."""
    cells, cut = cut_in_time(df, keys, time, limit)
    on = [*keys, CELL]
    pack = F.struct(*[F.col(src).alias(out) for out, src in columns.items()])
    out = cells.withColumn("_prior", F.lag(pack).over(W.partitionBy(*on).orderBy(time, tie)))
    if cut:
        tails = cells.groupBy(*on).agg(F.max_by(pack, F.struct(time, tie)).alias("_tail"))
        out = _handed_on(out, tails, on, "_tail", "_carry").withColumn("_prior", F.coalesce("_prior", "_carry"))
    return out.select(*df.columns, *[F.col("_prior." + name).alias(name) for name in columns])


def running_before(
    df: DataFrame, keys: Sequence[str], time: str, tie: str, totals: Mapping[str, Column], limit: int = ROWS_PER_TASK,
) -> DataFrame:
    """Sum of each expression over all earlier rows of the entity (0 for the first row)."""
    zero = F.lit(0)
    cells, cut = cut_in_time(df.withColumns({"_x_" + n: e for n, e in totals.items()}), keys, time, limit)
    on = [*keys, CELL]
    inside = W.partitionBy(*on).orderBy(time, tie).rowsBetween(W.unboundedPreceding, -1)
    out = cells.withColumns({"_i_" + n: F.coalesce(F.sum("_x_" + n).over(inside), zero) for n in totals})
    if cut:
        per_cell = cells.groupBy(*on).agg(*[F.sum("_x_" + n).alias("_c_" + n) for n in totals])
        earlier = W.partitionBy(*keys).orderBy(CELL).rowsBetween(W.unboundedPreceding, -1)
        carry = prefixed(per_cell.select(*on, *[F.sum("_c_" + n).over(earlier).alias("_k_" + n) for n in totals]), on)
        out = out.join(carry, same_keys(out, carry, on), "left")
        return out.select(*df.columns, *[(F.col("_i_" + n) + F.coalesce("_k_" + n, zero)).alias(n) for n in totals])
    return out.select(*df.columns, *[F.col("_i_" + n).alias(n) for n in totals])
