"""Replay and reporting queries over a scored table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselens import fixed
from caselens.functions.columns import local_iso, parse_reasons
from caselens.operators import dyadic, profile
from caselens.operators.flow import check_range, instants_checked, open_as_of, open_spans
from caselens.operators.prefix import running_totals
from caselens.operators.targets import TARGET, breach_rates
from caselens.spec import LifecycleSpec
from caselens.storage import settle

# Zone of naive timestamps and the queue's limits.
ZONE = "America/New_York"
DEFAULT_LIMIT = 100
MAX_LIMIT = 500

HOTSPOT_LEVELS = ("agency_complaint", "borough")


def queue_filters(
    df: DataFrame, spec: LifecycleSpec, group: str | None = None, region: str | None = None, min_risk: float = 0.0,
    risk: str = "risk",
) -> DataFrame:
    """Optional equality on upper-cased names and an inclusive risk floor."""
    if not 0.0 <= min_risk <= 1.0:
        raise ValueError("min_risk must be within [0, 1]")
    if group:
        df = df.where(F.col(spec.group) == group.upper())
    if region:
        df = df.where(F.col(spec.region) == region.upper())
    return df.where(F.col(risk) >= min_risk)


def _check_limit(limit: int) -> None:
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be within [1, {MAX_LIMIT}]")


def _items(
    df: DataFrame, spec: LifecycleSpec, at: Column, zone: str, reveal: bool, risk: str, extra: Sequence[str] = ()
) -> DataFrame:
    """Queue rows as seen at ``at``."""
    age = (F.unix_micros(at) - F.unix_micros(spec.start)) / F.lit(3_600_000_000.0)
    outcome = (
        [
            F.struct(
                (F.col("breach") == 1).alias("breached"),
                local_iso(spec.end, zone).alias("closed_at"),
                F.col(spec.hours).alias("resolution_hours"),
            ).alias("actual_outcome")
        ]
        if reveal
        else []
    )
    return df.select(
        *extra,
        spec.key,
        spec.group,
        spec.subgroup,
        spec.region,
        local_iso(spec.start, zone).alias("created_at"),
        F.round(age, 2).alias("age_hours"),
        risk,
        "risk_band",
        F.col(TARGET).alias("sla_threshold_hrs"),
        (age > F.col(TARGET)).alias("already_breached"),
        *outcome,
    )


def queue_total(
    scored: DataFrame, spec: LifecycleSpec, as_of: str, group: str | None = None, region: str | None = None,
    min_risk: float = 0.0, risk: str = "risk",
) -> DataFrame:
    """Queue length before the limit."""
    waiting = queue_filters(open_as_of(scored, spec, as_of), spec, group, region, min_risk, risk)
    return waiting.agg(F.count("*").alias("total"))


def riskiest(waiting: DataFrame, spec: LifecycleSpec, limit: int, risk: str = "risk") -> DataFrame:
    """The first ``limit`` rows, riskiest first, as a per-task top-k.

    Write the result before projecting it: a projection can move below the
    limit and turn the top-k into a sort of all rows.
    """
    return waiting.orderBy(F.desc(risk), F.asc(spec.key)).limit(limit)


def replay_queue(
    scored: DataFrame,
    spec: LifecycleSpec,
    as_of: str,
    replay: tuple[str, str],
    group: str | None = None,
    region: str | None = None,
    min_risk: float = 0.0,
    limit: int = DEFAULT_LIMIT,
    reveal: bool = False,
    zone: str = ZONE,
    risk: str = "risk",
) -> DataFrame:
    """What was open at ``as_of``, riskiest first; outcomes only when revealed."""
    check_range(as_of, *replay)
    _check_limit(limit)
    waiting = queue_filters(open_as_of(scored, spec, as_of), spec, group, region, min_risk, risk)
    best = settle(riskiest(waiting, spec, limit, risk), "queue")
    return _items(best, spec, F.lit(as_of).cast("timestamp"), zone, reveal, risk)


def first_of_spans(spans: DataFrame, numbered: DataFrame, spec: LifecycleSpec, levels: int, limit: int, risk: str) -> DataFrame:
    """number, key, risk, place: the first ``limit`` rows whose [lo, hi) holds the number, riskiest first."""
    best_first = [F.desc(risk), F.asc(spec.key)]
    nodes = dyadic.in_nodes(spans, dyadic.cover(F.col("lo"), F.col("hi"), levels)).select("level", "block", spec.key, risk)
    kept = nodes.withColumn("_place", F.row_number().over(Window.partitionBy("level", "block").orderBy(*best_first))).where(
        F.col("_place") <= limit)
    looking = dyadic.in_nodes(numbered, dyadic.above(F.col("number"), levels))
    merged = looking.join(kept.drop("_place"), ["level", "block"]).select(
        "number", spec.key, risk, F.row_number().over(Window.partitionBy("number").orderBy(*best_first)).alias("place"))
    return merged.where(F.col("place") <= limit)


def replay_queue_many(
    scored: DataFrame,
    times: DataFrame,
    spec: LifecycleSpec,
    replay: tuple[str, str],
    limit: int = DEFAULT_LIMIT,
    min_risk: float = 0.0,
    reveal: bool = False,
    zone: str = ZONE,
    risk: str = "risk",
) -> DataFrame:
    """The queue at every instant of ``times`` (column ``as_of``), with place and total.

    An instant with nothing open has one row with total 0 and no place.  One outside
    ``replay`` has one row with a reason and no total: the scored table doesn't hold what
    was open then.

    The instants are numbered, and the numbers a row is open at are cut into dyadic nodes.
    A node keeps its ``limit`` riskiest rows, cut within each task before the shuffle, and
    an instant merges those of the nodes it lies in; totals come from how many rows begin
    and end at a number.  No row meets an instant it is not among the first of a node for.
    """
    _check_limit(limit)
    queued = queue_filters(scored, spec, min_risk=min_risk, risk=risk)
    asked = settle(instants_checked(times, *replay), "instants")
    good = asked.where(F.col("_reject_reason").isNull()).select("as_of")
    levels = dyadic.levels_for(good.count())
    spans, numbered = open_spans(queued, spec, good, [spec.key, risk])
    spans, numbered = settle(spans, "spans"), settle(numbered, "numbers")
    best = settle(first_of_spans(spans, numbered, spec, levels, limit, risk), "queue")
    steps = spans.select(F.inline(F.array(
        F.struct(F.col("lo").alias("number"), F.lit(1).cast("long").alias("step")),
        F.struct(F.col("hi").alias("number"), F.lit(-1).cast("long").alias("step")),
    ))).groupBy("number").agg(F.sum("step").alias("step"))
    counted = running_totals(
        numbered.select("number").join(steps, "number", "left").select("number", F.coalesce("step", F.lit(0)).alias("step")),
        [], "number", ["step"], None)
    totals = numbered.join(counted.select("number", (F.col("before_step") + F.col("step")).alias("total")), "number")
    shown = queued.select(
        spec.key, spec.group, spec.subgroup, spec.region, spec.start, spec.end, spec.hours, "risk_band", TARGET, "breach")
    rows = best.join(shown, spec.key)
    placed = asked.join(totals, "as_of", "left").join(rows, "number", "left")
    return _items(placed, spec, F.col("as_of"), zone, reveal, risk, ["as_of", "_reject_reason", "place", "total"])


def ticket_detail(
    scored: DataFrame,
    keys: DataFrame,
    spec: LifecycleSpec,
    reveal: bool = False,
    zone: str = ZONE,
    risk: str = "risk",
    feature_names: Sequence[str] = fixed.FEATURES,
) -> tuple[DataFrame, DataFrame]:
    """Rows asked for by key, and the asked keys that do not exist.

    ``scored`` must have every column of ``feature_names``.
    """
    found = scored.join(keys.select(spec.key).distinct(), spec.key, "left_semi")
    missing = keys.select(spec.key).distinct().join(scored.select(spec.key), spec.key, "left_anti")
    reasons = F.col("top_reasons") if "top_reasons" in scored.columns else F.lit(None).cast("string")
    if dict(scored.dtypes).get("top_reasons", "string") == "string":
        reasons = parse_reasons(reasons)
    outcome = (
        [
            F.struct(
                (F.col("breach") == 1).alias("breached"),
                F.col("label_state"),
                local_iso(spec.end, zone).alias("closed_at"),
                F.col(spec.hours).alias("resolution_hours"),
            ).alias("actual_outcome")
        ]
        if reveal
        else []
    )
    detail = found.select(
        spec.key, spec.group, spec.subgroup, spec.detail, spec.region, spec.channel,
        F.col(spec.status).alias("status_at_extract"),
        local_iso(spec.start, zone).alias("created_at"),
        risk, "risk_band",
        F.col(TARGET).alias("sla_threshold_hrs"),
        reasons.alias("top_reasons"),
        F.struct(*[F.col(f) for f in feature_names]).alias("feature_values"),
        *outcome,
    )
    return detail, missing


def _in_period(df: DataFrame, spec: LifecycleSpec, lo: str | None, hi: str | None) -> DataFrame:
    """Starts within [lo, hi]; both are dates and either may be missing."""
    if lo is not None:
        df = df.where(F.col(spec.start) >= F.lit(lo).cast("timestamp"))
    if hi is not None:
        df = df.where(F.col(spec.start) < F.date_add(F.lit(hi).cast("date"), 1).cast("timestamp"))
    return df


def kpis(
    labeled: DataFrame, spec: LifecycleSpec, group: str | None = None, lo: str | None = None, hi: str | None = None,
    by_volume: bool = False,
) -> DataFrame:
    """Closed rows and breach rate per group, within the asked dates."""
    rows = _in_period(labeled, spec, lo, hi)
    if group:
        rows = rows.where(F.col(spec.group) == group.upper())
    rates = breach_rates(rows, [spec.group], spec)
    return rates.orderBy(F.desc("n"), spec.group) if by_volume else rates


def hotspots(
    labeled: DataFrame, spec: LifecycleSpec, level: str, lo: str | None = None, hi: str | None = None,
    k: int | None = None, min_n: int = 50,
) -> DataFrame:
    """Cohorts with the highest breach rate, then the most rows."""
    if level not in HOTSPOT_LEVELS:
        raise ValueError(f"level must be one of {', '.join(HOTSPOT_LEVELS)}")
    rows = _in_period(labeled, spec, lo, hi)
    if level == "agency_complaint":
        found = breach_rates(rows, spec.pair, spec, min_n=min_n)
    else:
        found = breach_rates(rows, [spec.group, spec.region], spec, not_null=[spec.region])
    return found.limit(k) if k else found


def metadata(
    scored: DataFrame, spec: LifecycleSpec, replay: tuple[str, str] | None = None, thresholds: DataFrame | None = None
) -> DataFrame:
    """Known groups, regions and channels as (column, value) rows; with them the replay range and the targets.

    A target is one row: group, subgroup, hours to six places and source, joined by ``|``.
    """
    rows = profile.domains(scored, [spec.group, spec.region, spec.channel])
    if replay is not None:
        both = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(v).alias("value")) for c, v in zip(
            ("replay_from", "replay_to"), replay)]))
        rows = rows.unionByName(scored.sparkSession.range(1).select(both))
    if thresholds is not None:
        spelled = F.concat_ws("|", *spec.pair, F.round(TARGET, 6).cast("string"), "target_source")
        rows = rows.unionByName(thresholds.select(F.lit("threshold").alias("column"), spelled.alias("value")))
    return rows


def subgroups_by_group(targets: DataFrame, spec: LifecycleSpec) -> DataFrame:
    return profile.children_by_parent(targets, spec.group, spec.subgroup)


def snapshot_summary(scored: DataFrame, spec: LifecycleSpec, replay: tuple[str, str], zone: str = ZONE) -> DataFrame:
    lo, hi = (local_iso(F.lit(edge).cast("timestamp"), zone) for edge in replay)
    return scored.agg(F.count("*").alias("tickets_loaded")).select(
        "tickets_loaded", lo.alias("replay_start"), hi.alias("replay_end_exclusive")
    )


def best_group(per_group: DataFrame, spec: LifecycleSpec) -> DataFrame:
    """The group with the highest PR-AUC."""
    best = F.max_by(F.struct(spec.group, "pr_auc"), F.col("pr_auc"))
    return per_group.where(F.col("pr_auc").isNotNull()).agg(best.alias("b")).select("b.*")


def overview(summary: DataFrame, report: dict[str, DataFrame], reconciled: DataFrame, model: str, baseline: str) -> DataFrame:
    """One row: replay size, top-decile precision and lift, PR-AUC against the baseline, accepted share."""
    one = F.lit(1).alias("_one")
    metrics = report["metrics"]
    chosen = metrics.where(F.col("model") == model).select(
        one, "pr_auc", "base_rate", "top_decile_precision", "top_decile_lift", "top_decile_recall"
    )
    other = metrics.where(F.col("model") == baseline).select(one, F.col("pr_auc").alias("baseline_pr_auc"))
    return (
        summary.select(one, F.col("tickets_loaded").alias("replay_population"))
        .join(chosen, "_one")
        .join(other, "_one")
        .join(reconciled.select(one, "acceptance_rate"), "_one")
        .drop("_one")
    )
