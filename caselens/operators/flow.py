"""Backlog, recent flow and as-of views of a lifecycle table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselens.functions.columns import day_number, seconds
from caselens.operators import dyadic
from caselens.operators.prefix import DAY, Total, global_total, totals_before
from caselens.spec import LifecycleSpec
from caselens.storage import settle

SECOND = "_start_second"


def with_second(df: DataFrame, spec: LifecycleSpec) -> DataFrame:
    return df.withColumn(SECOND, seconds(spec.start))


def activity(df: DataFrame, spec: LifecycleSpec, keys: Sequence[str]) -> DataFrame:
    """Starts, ends and net change of open rows per (keys, second), written.

    One scan emits both ends of a row; the combine before the shuffle leaves at
    most one row per second of a group, so everything below is independent of
    how many rows a group holds.
    """
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    started = F.struct(seconds(spec.start).alias("at"), one.alias("arrivals"), zero.alias("closures"))
    ended = F.struct(seconds(spec.end).alias("at"), zero.alias("arrivals"), one.alias("closures"))
    events = df.select(*keys, F.explode(F.array(started, ended)).alias("_e")).where(F.col("_e.at").isNotNull())
    counted = events.groupBy(*keys, F.col("_e.at").alias(SECOND)).agg(
        F.sum("_e.arrivals").alias("arrivals"), F.sum("_e.closures").alias("closures")
    )
    return settle(counted.withColumn("net", F.col("arrivals") - F.col("closures")), "activity")


def at_starts(points: DataFrame, keys: Sequence[str], totals: Mapping[str, Total]) -> DataFrame:
    """Totals strictly before each second in which a row of the group starts."""
    return totals_before(points, None, keys, SECOND, totals, where=F.col("arrivals") > 0)


def _attach(df: DataFrame, points: DataFrame, spec: LifecycleSpec, keys: Sequence[str], outputs: Sequence[str]) -> DataFrame:
    """Rows whose key is NULL match nothing and get 0."""
    joined = with_second(df, spec).join(points, [*keys, SECOND], "left")
    return joined.fillna(0, subset=list(outputs)).drop(SECOND)


def backlog(df: DataFrame, spec: LifecycleSpec, keys: Sequence[str], out: str) -> DataFrame:
    """Rows of the same group open just before each row's start second."""
    points = at_starts(activity(df, spec, keys), keys, {out: Total("net")})
    return _attach(df, points, spec, keys, [out])


def flow_counts(
    df: DataFrame,
    spec: LifecycleSpec,
    keys: Sequence[str],
    width: int = DAY,
    arrivals: str = "agency_arrivals_24h",
    closures: str = "agency_closures_24h",
) -> DataFrame:
    """Starts and ends of the group in [t - width, t) for each row starting at t."""
    totals = {arrivals: Total("arrivals", width), closures: Total("closures", width)}
    return _attach(df, at_starts(activity(df, spec, keys), keys, totals), spec, keys, [arrivals, closures])


def recent_unresolved_proxy(df: DataFrame, spec: LifecycleSpec, days: int = 7, out: str = "backlog_7d_at_creation") -> DataFrame:
    """Group's rows started in the prior days that have no end or end after their own start.

    Each counted row is compared with itself, so this is near to an arrival
    count; ``backlog`` is the count of rows open at the instant.
    """
    unresolved = F.col(spec.end).isNull() | (F.col(spec.end) > F.col(spec.start))
    counted = with_second(df, spec).groupBy(spec.group, SECOND).agg(F.count_if(unresolved).alias("unresolved"))
    totals = {out: Total("unresolved", days * DAY)}
    points = totals_before(settle(counted, "activity"), None, [spec.group], SECOND, totals)
    return _attach(df, points, spec, [spec.group], [out])


def opened_so_far(df: DataFrame, spec: LifecycleSpec, out: str = "opened_so_far", strict: bool = False) -> DataFrame:
    """Group's starts up to the row's start second; ``strict`` leaves that second out."""
    keys = [spec.group]
    counted = with_second(df, spec).groupBy(*keys, SECOND).agg(F.count("*").alias("arrivals"))
    totals = {out: Total("arrivals", inclusive=not strict)}
    return _attach(df, totals_before(settle(counted, "activity"), None, keys, SECOND, totals), spec, keys, [out])


def is_open_at(spec: LifecycleSpec, at: str | Column) -> Column:
    """Started before and not ended by ``at``, both sides strict."""
    when = F.lit(at).cast("timestamp") if isinstance(at, str) else at
    return (F.col(spec.start) < when) & (F.col(spec.end).isNull() | (F.col(spec.end) > when))


def open_as_of(df: DataFrame, spec: LifecycleSpec, at: str) -> DataFrame:
    return df.where(is_open_at(spec, at))


def open_during(df: DataFrame, spec: LifecycleSpec, lo: str, hi: str) -> DataFrame:
    """Rows open at any point of [lo, hi)."""
    low, high = F.lit(lo).cast("timestamp"), F.lit(hi).cast("timestamp")
    return df.where((F.col(spec.start) < high) & (F.col(spec.end).isNull() | (F.col(spec.end) >= low)))


def check_range(at: str, lo: str, hi: str) -> None:
    low, when, high = (datetime.fromisoformat(text) for text in (lo, at, hi))
    if not low <= when < high:
        raise ValueError(f"as_of must be within [{lo}, {hi})")


def open_counts_at(
    df: DataFrame, spec: LifecycleSpec, times: DataFrame, keys: Sequence[str] = (), at: str = "as_of", out: str = "n"
) -> DataFrame:
    """Rows open at every instant of ``times``, per group of ``keys``: the difference of two running totals.

    No row meets an instant.  Both sides of "open" are strict, so a row enters a microsecond after its start and
    leaves at its end, or at once when it ends before it starts.  A group without open rows has no row.  Running totals
    go by range partitions of the moves, so a busy day is cut like any other stretch.
    """
    enters = F.unix_micros(spec.start) + 1
    leaves = F.greatest(F.unix_micros(spec.end), enters)
    moves = F.array(
        F.struct(enters.alias("us"), F.lit(1).cast("long").alias("step")),
        F.when(F.col(spec.end).isNotNull(), F.struct(leaves.alias("us"), F.lit(-1).cast("long").alias("step"))),
    )
    points = df.where(F.col(spec.start).isNotNull()).select(*keys, F.explode(F.array_compact(moves)).alias("m")).groupBy(
        *keys, F.col("m.us").alias("us")
    ).agg(F.sum("m.step").alias("step"))
    points = settle(points, "moves")
    # An instant sees what has happened up to and with it: the totals before the next microsecond.
    asked = times.select((F.unix_micros(F.col(at).cast("timestamp")) + 1).alias("us")).distinct()
    if keys:
        asked = _for_each(asked, settle(points.select(*keys).distinct(), "groups"))
    found = totals_before(points, asked, list(keys), "us", {out: Total("step")}, grain=None)
    return found.where(F.col(out) > 0).select(*keys, F.timestamp_micros(F.col("us") - 1).alias(at), out)


def _for_each(asked: DataFrame, groups: DataFrame, per_task: int = 1 << 20) -> DataFrame:
    """Every instant with every group; the groups are repeated so that a task makes ``per_task`` rows of the answer."""
    asked = settle(asked, "instants")
    salts = max(1, -(-asked.count() * groups.count() // per_task))
    many = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return asked.withColumn("_salt", F.pmod(F.xxhash64("us"), F.lit(salts)).cast("int")).join(many, "_salt").drop("_salt")


def instants_checked(times: DataFrame, lo: str, hi: str, at: str = "as_of") -> DataFrame:
    """The instants, with a reason where they are missing or outside [lo, hi)."""
    when = F.col(at).cast("timestamp")
    outside = (when < F.lit(lo).cast("timestamp")) | (when >= F.lit(hi).cast("timestamp"))
    return times.select(when.alias(at)).distinct().withColumn(
        "_reject_reason", F.when(when.isNull(), "as_of_missing").when(outside, "as_of_out_of_range")
    )


def open_as_of_many(
    df: DataFrame, spec: LifecycleSpec, times: DataFrame, at: str = "as_of", per_task: int = 1 << 20
) -> DataFrame:
    """Every (instant, row open at it), for a table of instants.

    The days a row is open, clipped to the days asked for, are listed as dyadic
    nodes: at most two a level, 16 for half a year instead of 180 days.  An instant
    looks in the nodes its day lies in.  A node with more than ``per_task`` rows is
    cut in as many parts, and its instants are repeated for each.
    """
    days = times.agg(F.min(day_number(at)), F.max(day_number(at))).first()
    if days[0] is None:
        return df.limit(0).withColumn(at, F.lit(None).cast("timestamp"))
    first, last, levels = F.lit(days[0]), F.lit(days[1]), dyadic.levels_for(days[1] - days[0] + 1)
    begin = F.greatest(day_number(spec.start), first) - first
    finish = F.least(F.coalesce(day_number(spec.end), last), last) - first
    rows = dyadic.in_nodes(df.where(begin <= finish), dyadic.cover(begin, finish + 1, levels))
    parts = settle(
        rows.groupBy("level", "block").agg(F.ceil(F.count("*") / F.lit(per_task)).cast("int").alias("_parts")), "node-parts"
    )
    salted = rows.join(parts, ["level", "block"]).withColumn("_salt", F.pmod(F.xxhash64(spec.key), F.col("_parts")).cast("int"))
    instants = times.select(F.col(at).cast("timestamp").alias(at)).distinct()
    looking = dyadic.in_nodes(instants, dyadic.above(day_number(at) - first, levels)).join(parts, ["level", "block"]).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    return salted.drop("_parts").join(looking, ["level", "block", "_salt"]).where(is_open_at(spec, F.col(at))).drop(
        "level", "block", "_salt")


def open_spans(df: DataFrame, spec: LifecycleSpec, instants: DataFrame, carry: Sequence[str], at: str = "as_of") -> tuple[DataFrame, DataFrame]:
    """Rows with the instants they are open at as a range of numbers [lo, hi), and the instants with their numbers.

    Both ends of a row are counted among the instants in one pass over range partitions, so no row meets an
    instant.  Rows open at none of them are left out; rows that agree in ``carry`` are one.
    """
    starts = F.struct((F.unix_micros(spec.start) + 1).alias("us"), F.lit(0).alias("side"))
    ends = F.struct(F.coalesce(F.unix_micros(spec.end), F.lit((1 << 63) - 1)).alias("us"), F.lit(1).alias("side"))
    none = [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in carry]
    moves = df.where(F.col(spec.start).isNotNull()).select(*carry, F.inline(F.array(starts, ends)))
    asked = instants.select(*none, F.unix_micros(at).alias("us"), F.lit(2).alias("side"))
    is_asked = (F.col("side") == 2).cast("int")
    # Of equal times, ends and starts come before the instant.
    placed = global_total(moves.unionByName(asked), ["us", "side"], is_asked, "n")
    numbered = placed.where("side = 2").select(F.timestamp_micros("us").alias(at), (F.col("n") - 1).alias("number"))
    spans = placed.where("side < 2").groupBy(*carry).agg(
        F.min(F.when(F.col("side") == 0, F.col("n"))).alias("lo"), F.max(F.when(F.col("side") == 1, F.col("n"))).alias("hi"))
    return spans.where("lo < hi"), numbered
