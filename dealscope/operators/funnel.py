"""The sales funnel: five ordered stages, counted in three ways.

A unit is an agent, or an agent in a calendar period.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealscope.operators.facts import attribute, stage_mark, stage_number


# A digit of a path, and how many stages leave room for the time
# that orders paths in the same number.
DIGIT = 15
MOST_STAGES = 9
PATH_BITS = 4 * (MOST_STAGES + 1)


def funnel_reached(marks: DataFrame, n_stages: int, period: str | None = None,
                   agents: DataFrame | None = None, by_period: bool = False) -> DataFrame:
    """Units that touched each stage: ``[dims], stage_no, units``."""
    def touched(stage: int) -> Column:
        return F.col("mask").bitwiseAND(F.lit(1 << (stage - 1))) != 0

    return _count_stages(_unit_masks(marks, period), n_stages, touched, agents, by_period,
                         conversions=False)


def funnel_snapshot(marks: DataFrame, n_stages: int, period: str | None = None,
                    agents: DataFrame | None = None, by_period: bool = False) -> DataFrame:
    """Units whose furthest stage is at or beyond each stage, with conversions.

    Output: ``[dims], stage_no, units, conv_prev, conv_top``. A unit reached
    stage ``n`` or beyond exactly when its mask is at least ``2**(n-1)``.
    """
    def reached(stage: int) -> Column:
        return F.col("mask") >= F.lit(1 << (stage - 1))

    return _count_stages(_unit_masks(marks, period), n_stages, reached, agents, by_period,
                         conversions=True)


def unit_states(stage_days: DataFrame, period: str | None = None) -> DataFrame:
    """``agent_id, period, mask, stage``: which stages a unit touched and how far it came in time order.

    Takes the rows of :func:`stage_paths` with masks; ``period`` is null where units are agents.
    """
    start = _period_start(F.col("day"), period) if period else F.lit(None).cast("date")
    reached = F.aggregate("steps", F.lit(0).cast("bigint"), lambda at, step: _digit(step, at))
    return stage_days.groupBy("agent_id", start.alias("period")).agg(
        F.bit_or("mask").cast("bigint").alias("mask"), _in_order(F.unix_date("day")).alias("steps")
    ).select("agent_id", "period", "mask", reached.cast("bigint").alias("stage"))


def counted_units(cells: DataFrame, n_stages: int, kind: str, dims: Sequence[str] = ()) -> DataFrame:
    """A funnel from counted units (``dims, mask, stage, n``): ``kind`` is ``reached``, ``snapshot`` or ``ordered``."""
    holds = {
        "reached": lambda stage: F.col("mask").bitwiseAND(F.lit(1 << (stage - 1))) != 0,
        "snapshot": lambda stage: F.col("mask") >= F.lit(1 << (stage - 1)),
        "ordered": lambda stage: F.col("stage") >= stage,
    }[kind]
    return _stage_rows(cells, n_stages, holds, list(dims), F.col("n"), kind == "snapshot")


def _period_start(day: Column, period: str) -> Column:
    return F.trunc(day, period)


def _unit_masks(marks: DataFrame, period: str | None) -> DataFrame:
    """One row per unit. The bit-or combines before the shuffle, so a unit that
    holds a third of all events sends one row per task."""
    unit = [F.col("agent_id")]
    if period:
        unit.append(_period_start(F.col("day"), period).alias("period"))
    return marks.groupBy(*unit).agg(F.bit_or("mask").alias("mask"))


def _count_stages(units: DataFrame, n_stages: int, holds: Callable[[int], Column],
                  agents: DataFrame | None, by_period: bool, conversions: bool) -> DataFrame:
    dims = ["period"] if by_period else []
    if agents is not None:
        # One row per agent (and period) and mask, however many units it has.
        units = units.groupBy("agent_id", *dims, "mask").agg(F.count("*").alias("n"))
        units = attribute(units, agents)
        dims = ["agency_id", *dims]
    weight = F.col("n") if agents is not None else F.lit(1).cast("bigint")
    return _stage_rows(units, n_stages, holds, dims, weight, conversions)


def _stage_rows(units: DataFrame, n_stages: int, holds: Callable[[int], Column], dims: list[str], weight: Column,
                conversions: bool) -> DataFrame:
    """The units of each stage, one row a stage."""
    wide = units.groupBy(*dims).agg(*[
        F.coalesce(F.sum(F.when(holds(stage), weight)), F.lit(0)).cast("bigint").alias(f"s{stage}")
        for stage in range(1, n_stages + 1)
    ])
    rows = []
    for stage in range(1, n_stages + 1):
        here = F.col(f"s{stage}")
        fields = [F.lit(stage).cast("bigint").alias("stage_no"), here.alias("units")]
        if conversions:
            before = F.lit(None).cast("double") if stage == 1 else _ratio(here, F.col(f"s{stage - 1}"))
            fields += [before.alias("conv_prev"), _ratio(here, F.col("s1")).alias("conv_top")]
        rows.append(F.struct(*fields))
    return wide.select(*dims, F.inline(F.array(*rows)))


def _ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def stage_paths(events: DataFrame, stages: Sequence[str], *extra: str, masks: bool = False) -> DataFrame:
    """What one day does to an agent's progress: ``agent_id, day, path``, with
    ``masks`` also the day's ``mask`` of :func:`facts.roll_up_marks`.

    A path says, for every stage an agent may stand at in the morning, where
    they stand in the evening, moving up whenever the next stage occurs at the
    same or a later moment. Paths compose in time order, so a long history is
    folded piece by piece, and no task ever holds a whole unit:

    * a second has at most a million distinct moments (timestamps are in
      microseconds), each with one entry per stage, copies being dropped;
    * a day has 86,400 seconds.

    Both groups are bounded by the calendar, whatever the number of rows, and
    one agent's events are spread over tasks by the second.

    A path is one number, a digit of four bits per stage stood at, so the groups
    are arrays of numbers that sort fast.
    """
    if len(stages) > MOST_STAGES:
        raise ValueError(f"a path holds at most {MOST_STAGES} stages")
    ts = F.col("ts").cast("timestamp")
    place = stage_number(F.col("stage_code"), stages) - 1
    # Negative, so that an ascending sort puts the last moment first.
    moment = -(F.unix_micros(ts) * (DIGIT + 1) + place)
    day = F.col("second").cast("date")
    since_midnight = F.unix_seconds("second") - F.unix_seconds(day.cast("timestamp"))
    bit = stage_mark(F.col("stage_code"), stages)
    mask = ["mask"] if masks else []
    return (
        events.where(F.col("stage_code").isin(list(stages)) & F.col("ts").isNotNull())
        .groupBy(*extra, "agent_id", F.date_trunc("second", ts).alias("second"))
        .agg(F.sort_array(F.collect_set(moment)).alias("moments"), *([F.bit_or(bit).alias("mask")] if masks else []))
        .select(*extra, "agent_id", "second", _path_of("moments", len(stages)).alias("path"), *mask)
        .groupBy(*extra, "agent_id", day.alias("day"))
        .agg(_in_order(since_midnight).alias("steps"), *([F.bit_or("mask").alias("mask")] if masks else []))
        .select(*extra, "agent_id", "day", *mask, _compose("steps", len(stages)).alias("path"))
    )


def _shift(name: str, number: Column, digits: Column) -> Column:
    return F.call_function(name, number, (digits * 4).cast("int"))


def _digit(path: Column, stage: Column) -> Column:
    return _shift("shiftright", path, stage).bitwiseAND(F.lit(DIGIT).cast("bigint"))


def _staying(n_stages: int) -> Column:
    return F.lit(sum(stage << 4 * stage for stage in range(n_stages + 1))).cast("bigint")


def _path_of(moments: str, n_stages: int) -> Column:
    """Fold moments, the last one first. Whoever stands below the stage of a
    moment ends where standing at that stage leads from then on: its digit is
    overwritten by the next one."""
    def earlier(path: Column, moment: Column) -> Column:
        place = (-moment).bitwiseAND(F.lit(DIGIT).cast("bigint"))
        digit = _shift("shiftleft", F.lit(DIGIT).cast("bigint"), place)
        return path.bitwiseXOR(path.bitwiseXOR(F.shiftright(path, 4)).bitwiseAND(digit))

    start = _staying(n_stages)
    only = earlier(start, F.element_at(moments, 1))
    return F.when(F.size(moments) == 1, only).otherwise(F.aggregate(moments, start, earlier))


def _in_order(time: Column) -> Column:
    """The paths of a group in the order of ``time``, which rides in the upper bits."""
    return F.sort_array(F.collect_list(time * F.lit(1 << PATH_BITS) + F.col("path")))


def _path_in(step: Column) -> Column:
    return step.bitwiseAND(F.lit((1 << PATH_BITS) - 1))


def _compose(steps: str, n_stages: int) -> Column:
    """One path for several, the first one first."""
    def then(path: Column, step: Column) -> Column:
        digits = [
            F.shiftleft(_digit(step, _digit(path, F.lit(stage))), 4 * stage) for stage in range(n_stages + 1)
        ]
        return reduce(Column.bitwiseOR, digits)

    only = _path_in(F.element_at(steps, 1))
    return F.when(F.size(steps) == 1, only).otherwise(F.aggregate(steps, _staying(n_stages), then))


def funnel_ordered(paths: DataFrame, n_stages: int, period: str | None = None,
                   agents: DataFrame | None = None, by_period: bool = False) -> DataFrame:
    """Units that passed the stages in time order: ``[dims], stage_no, units``.

    Takes the daily paths of :func:`stage_paths`; a unit has at most one per day
    of its history.
    """
    unit = [F.col("agent_id")]
    if period:
        unit.append(_period_start(F.col("day"), period).alias("period"))
    reached = F.aggregate("steps", F.lit(0).cast("bigint"), lambda at, step: _digit(step, at))
    final = (
        paths.groupBy(*unit)
        .agg(_in_order(F.unix_date("day")).alias("steps"))
        .withColumn("mask", reached)
        .drop("steps")
    )
    return _count_stages(final, n_stages, lambda stage: F.col("mask") >= stage, agents, by_period,
                         conversions=False)
