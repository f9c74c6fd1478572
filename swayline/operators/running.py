"""Global running sums and exact percentiles without a single-task sort.

A window ordered over a whole table runs in one task. Here the rows are first dealt into ranges that follow the order,
each range is summed in its own task, and the totals of the earlier ranges are added on top.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from swayline.config import CurveConfig
from swayline.functions.columns import clean
from swayline.sources.storage import BROADCAST_ROWS, by_rows, materialise

BUCKET = "_bucket"
STEPS = 64  # of a bracket in a round
TOP_ROWS = 100_000  # of an order that one task may hold


@dataclass(frozen=True)
class Cuts:
    """How many ranges a table's order is cut into. Where the borders lie is Spark's range exchange's business: data, not part of a plan."""

    buckets: int


def bucket_count(rows: int, parallelism: int, cfg: CurveConfig) -> int:
    """Buckets grow with the rows, so a bucket does not."""
    return max(1, parallelism, math.ceil(rows / cfg.rows_per_bucket))


def join_same(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal values of ``on``, where a missing value equals a missing value. Spark chooses the strategy."""
    other = right.select(*[F.col(c).alias(f"_same_{c}") for c in on], *[c for c in right.columns if c not in on])
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_same_{c}")) for c in on])
    return left.join(other, same, how).drop(*[f"_same_{c}" for c in on])


def find_cuts(df: DataFrame, score: str, tie_break: str | None, keys: Sequence[str], cfg: CurveConfig) -> Cuts:
    """Ranges of about ``rows_per_bucket`` rows; the driver sees the row count only."""
    return Cuts(bucket_count(df.count(), df.sparkSession.sparkContext.defaultParallelism, cfg))


def order_of(score: str, tie_break: str | None, descending: bool) -> list[Column]:
    """Missing scores come last in either direction."""
    first = F.col(score).desc_nulls_last() if descending else F.col(score).asc_nulls_last()
    return [first, F.col(tie_break).asc_nulls_first()] if tie_break else [first]


def assign_buckets(df: DataFrame, score: str, tie_break: str | None, cuts: Cuts, descending: bool) -> DataFrame:
    """``df`` dealt into ranges of the wanted order and written with the number of each row's range, which grows with the order.

    Ranges are cut by score and, within a score, by the tie-break column's own values, so a score held by most rows and ids that begin
    alike are spread. Numbers are written: whatever is lost and read again has the same ones. Several keys share the ranges.
    """
    dealt = df.repartitionByRange(cuts.buckets, *order_of(score, tie_break, descending))
    return materialise(dealt.withColumn(BUCKET, F.spark_partition_id()), "ranges")


def running_sums(
    df: DataFrame,
    score: str,
    sums: dict[str, Column],
    *,
    tie_break: str | None = "member_id",
    keys: Sequence[str] = (),
    descending: bool = True,
    up_to: tuple[str, int] | None = None,
    first: int | None = None,
    cuts: Cuts | None = None,
    cfg: CurveConfig = CurveConfig(),
) -> DataFrame:
    """Running total, per key, of each expression in ``sums`` in score order, this row included.

    ``before_<name>`` carries the total up to the row before. With a ``tie_break`` every row is a point and all
    columns are kept. Without one, rows of equal score become one point ``(keys.., score)`` before they are dealt; they are combined
    on the map side, so a score held by most rows is no burden.

    ``first=n`` keeps the first n rows of the order (no keys): up to ``TOP_ROWS`` every task finds its own first n before anything is
    dealt, beyond that ranges past them are left out. ``up_to=(name, n)`` leaves out ranges in which that running total is past ``n`` from the start. The rows are written once, dealt
    by range; totals of ranges become offsets, joined as a table. ``cuts`` of the same table can be reused.
    """
    ready = df.withColumn(score, clean(F.col(score)))
    if first is not None and first <= TOP_ROWS:
        ready = ready.orderBy(*order_of(score, tie_break, descending)).limit(first)
        cuts = Cuts(bucket_count(first, df.sparkSession.sparkContext.defaultParallelism, cfg))
    cuts = cuts or find_cuts(ready, score, tie_break, keys, cfg)
    own = {n: f"_own_{n}" for n in sums}
    if tie_break:
        kept, ties = df.columns, [F.col(tie_break).asc_nulls_first()]
        points = ready.withColumns({own[n]: c for n, c in sums.items()})
    else:
        kept, ties = [*keys, score], []
        points = ready.groupBy(*keys, score).agg(*[F.sum(c).alias(own[n]) for n, c in sums.items()])
    points = assign_buckets(points, score, tie_break, cuts, descending)
    place = [*keys, BUCKET]
    if first is not None:
        sums, up_to = {**sums, "_first": F.lit(1)}, up_to or ("_first", first)
        points = points.withColumn("_own__first", F.lit(1))
        own = {**own, "_first": "_own__first"}

    totals = points.groupBy(*place).agg(*[F.sum(c).alias(f"_all_{n}") for n, c in own.items()])
    earlier = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = totals.select(*place, *[
        F.coalesce(F.sum(f"_all_{n}").over(earlier), F.lit(0)).alias(f"_off_{n}") for n in sums])
    if up_to:
        name, limit = up_to
        offsets = offsets.filter(F.col(f"_off_{name}") < limit)
        points = join_same(points, offsets.select(place), place, "left_semi")
    upto = Window.partitionBy(*place).orderBy(order_of(score, None, descending)[0], *ties).rowsBetween(Window.unboundedPreceding, 0)
    inside = points.select("*", *[F.sum(c).over(upto).alias(f"_in_{n}") for n, c in own.items()])
    inside = join_same(inside, offsets, place)
    if first is not None:
        inside = inside.filter(F.col("_in__first") + F.col("_off__first") <= first)
    running = {n: F.col(f"_in_{n}") + F.col(f"_off_{n}") for n in sums if n != "_first"}
    return inside.select(
        *kept,
        *[c.alias(n) for n, c in running.items()],
        *[(c - F.col(own[n])).alias(f"before_{n}") for n, c in running.items()],
    )


def cells(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep.., pos, value): one row per value, the column as its number, NaN as null.

    Statistics of many columns run faster over this than as one very wide aggregate, whose generated code outgrows
    the compiler; and a number is a cheaper key than a name. Cells never leave their task, only partial sums do.
    """
    values = F.array(*[F.col(c).cast("double") for c in columns])
    return df.select(*keep, F.posexplode(values).alias("pos", "value")).withColumn("value", clean(F.col("value")))


def name_of(columns: Sequence[str]) -> Column:
    """Column name of a cell's number."""
    return F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("pos") + 1)


def number_of(columns: Sequence[str]) -> Column:
    """Cell number of a feature name."""
    return (F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("feature")) - 1).cast("int")


def _meeting(values: DataFrame, limits: DataFrame, place: Sequence[str]) -> DataFrame:
    """Cells next to the limits of their group and column. ``limits`` is written, one row per group and column.

    Spark's estimate of the cells does not know how many rows an array becomes, so it would send them, not the limits, to every executor.
    """
    return join_same(values, by_rows(limits, BROADCAST_ROWS), place)


def _narrowed(values: DataFrame, limits: DataFrame, place: Sequence[str], shares: Sequence[tuple[int, int]], window_rows: int) -> DataFrame:
    """``limits`` with brackets narrowed, round by round, until each holds at most ``window_rows`` rows or can be narrowed no more.

    A round is one aggregate: values in a bracket fall into ``STEPS`` equal steps, and the bracket becomes what lies between the least value of
    the wanted rank's step and the largest of the next rank's. A rank outside its bracket widens it to that side.
    """
    numbers = range(len(shares))
    while True:
        wanted = F.array(*[F.struct(F.lit(i).alias("share_no"), F.expr(f"((n - 1) * {num}) div {den}").alias("rank"),
                                    F.col(f"lo_{i}").alias("lo"), F.col(f"hi_{i}").alias("hi")) for i, (num, den) in enumerate(shares)])
        each = _meeting(values, limits, place).select(*place, "value", "n", F.inline(wanted))
        width = F.col("hi") - F.col("lo")
        step = (F.when(F.col("value") < F.col("lo"), -1).when(F.col("value") > F.col("hi"), STEPS).when(width <= 0, 0)
                .when(width == float("inf"), (F.col("value") >= 0).cast("int") * (STEPS - 1))
                .otherwise(F.least(F.lit(STEPS - 1), F.floor((F.col("value") - F.col("lo")) / width * STEPS).cast("int"))))
        counted = each.groupBy(*place, "n", "share_no", "rank", "lo", "hi", step.alias("step")).agg(
            F.count("*").alias("rows"), F.min("value").alias("least"), F.max("value").alias("most"))
        upto = Window.partitionBy(*place, "share_no").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)  # STEPS + 2 rows
        counted = counted.withColumn("upto", F.sum("rows").over(upto)).withColumn("start", F.col("upto") - F.col("rows"))
        holds = lambda r: (F.col("start") <= r) & (r < F.col("upto"))
        first, second = F.col("rank"), F.least(F.col("rank") + 1, F.col("n") - 1)
        between = (F.col("upto") > first) & (F.col("start") <= second)
        found = materialise(counted.groupBy(*place, "n", "share_no", "lo", "hi").agg(
            F.max(F.when(holds(first), F.col("least"))).alias("new_lo"), F.max(F.when(holds(second), F.col("most"))).alias("new_hi"),
            F.sum(F.when(between, F.col("rows")).otherwise(0)).alias("inside")), "brackets")
        limits = found.groupBy(*place).agg(F.any_value("n").alias("n"), *[
            F.max(F.when(F.col("share_no") == i, F.col(f"new_{e}"))).alias(f"{e}_{i}") for i in numbers for e in ("lo", "hi")])
        moved = (F.col("new_lo") != F.col("lo")) | (F.col("new_hi") != F.col("hi"))
        limits = materialise(limits, "limits")
        if not found.filter((F.col("inside") > window_rows) & (F.col("new_lo") < F.col("new_hi")) & moved).limit(1).count():
            return limits


def exact_percentiles(
    df: DataFrame,
    columns: Sequence[str],
    shares: Sequence[tuple[int, int]],
    by: Sequence[str] = (),
    accuracy: int = 10_000,
    window_rows: int = 1 << 18,
) -> DataFrame:
    """Percentiles with linear interpolation, exact: (by.., feature, share_no, value).

    Shares are fractions (numerator, denominator), so the wanted rank is integer arithmetic. A sketch per group and
    column brackets each wanted rank; one more pass counts values below each bracket, keeps the nearest value on
    either side, and only values inside are grouped and ordered, equal ones counted together. A bracket holds at most 8/``accuracy`` of a
    column's rows; where that can be more than ``window_rows``, brackets are narrowed in rounds first, so the ordered rows of one
    task have that bound at any size. A rank that is found neither inside nor next to its bracket stops the job.
    """
    value, place, numbers = F.col("value"), [*by, "pos"], range(len(shares))
    slack = 3.0 / accuracy
    ends = [min(1.0, max(0.0, n / d + s)) for n, d in shares for s in (-slack, slack)]
    values = cells(df, columns, by).filter(value.isNotNull())
    sketch = values.groupBy(*place).agg(F.count("*").alias("n"), F.percentile_approx("value", F.lit(ends), F.lit(accuracy)).alias("ends"))
    limits = sketch.select(*place, "n", *[F.col("ends")[2 * i + e].alias(f"{name}_{i}") for i in numbers for e, name in enumerate(("lo", "hi"))])
    limits = materialise(limits, "limits")
    if df.count() * 8 > window_rows * accuracy:
        limits = _narrowed(values, limits, place, shares, window_rows)

    def edge(name: str, i: int) -> Column:
        return F.col(f"{name}_{i}")

    # Every cell meets its limits once; only one partial row per group, column and value inside leaves its task.
    inside = reduce(Column.__or__, [value.between(edge("lo", i), edge("hi", i)) for i in numbers])
    sides = [c for i in numbers for c in (
        F.count_if(value < edge("lo", i)).alias(f"under_{i}"), F.max(F.when(value < edge("lo", i), value)).alias(f"left_{i}"),
        F.min(F.when(value > edge("hi", i), value)).alias(f"right_{i}"))]
    grouped = _meeting(values, limits, place).groupBy(*place, F.when(inside, value).alias("value")).agg(
        F.count("*").alias("rows"), F.any_value("n").alias("n"),
        *[F.any_value(f"{e}_{i}").alias(f"{e}_{i}") for i in numbers for e in ("lo", "hi")], *sides)
    per_share = F.array(*[F.struct(
        F.lit(i).alias("share_no"), F.expr(f"((n - 1) * {num}) div {den}").alias("rank"),
        (((F.col("n") - 1) * num % den) / F.lit(float(den))).alias("rest"),
        *[edge(name, i).alias(name) for name in ("lo", "hi", "under", "left", "right")]) for i, (num, den) in enumerate(shares)])
    near = grouped.select(*place, "value", "rows", "n", F.inline(per_share))

    whole = Window.partitionBy(*place, "share_no")
    upto = whole.orderBy(F.col("value").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    mine = F.when(value.between(F.col("lo"), F.col("hi")), F.col("rows")).otherwise(0)
    counted = near.withColumn("mine", mine).withColumn("before", F.sum("under").over(whole)).withColumn(
        "upto", F.col("before") + F.sum("mine").over(upto)).withColumn("start", F.col("upto") - F.col("mine"))

    def value_at(rank: Column) -> Column:
        found = F.max(F.when((F.col("start") <= rank) & (rank < F.col("upto")), value))
        left = F.when(F.max(rank) == F.max("before") - 1, F.max("left"))
        right = F.when(F.max(rank) == F.max("upto"), F.min("right"))
        return F.coalesce(found, left, right)

    picked = counted.groupBy(*place, "share_no", "rest").agg(
        value_at(F.col("rank")).alias("low"), value_at(F.least(F.col("rank") + 1, F.col("n") - 1)).alias("high"))
    missed = F.raise_error(F.lit("a wanted rank lies outside its bracket")).cast("double")
    low, high = (F.coalesce(F.col(c), missed) for c in ("low", "high"))
    return picked.select(*by, name_of(columns).alias("feature"), "share_no", (low + (high - low) * F.col("rest")).alias("value"))
