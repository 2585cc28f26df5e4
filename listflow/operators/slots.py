"""Publishing slots: legal candidates, queue spacing, ranking and assignment."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listflow import constants as K
from listflow.functions import dates
from listflow.session import cut_lineage

_STEP = 15


def _quarter_up(t: dt.datetime) -> dt.datetime:
    over = (t.minute % _STEP) * 60 + t.second + t.microsecond / 1e6
    return t if not over else (t + dt.timedelta(seconds=_STEP * 60 - over)).replace(microsecond=0)


def _earliest(as_of: str) -> dt.datetime:
    return dt.datetime.fromisoformat(as_of) + dt.timedelta(hours=2)


def _on_days(days: DataFrame) -> DataFrame:
    """Every quarter hour inside a band that the weekday of ``day`` allows."""
    bands = F.array(*[
        F.struct(F.lit(r).alias("band"), F.lit(a).alias("first"), F.lit(b).alias("last"),
                 F.lit(m).alias("mid"), F.array(*[F.lit(d) for d in on]).alias("days"))
        for r, a, b, m, on in K.SLOT_BANDS])
    weekday = F.weekday("day") + 1
    rows = days.withColumn("_b", F.explode(F.filter(
        bands, lambda x: F.array_contains(x["days"], weekday)))).withColumn(
        "minute", F.explode(F.sequence("_b.first", "_b.last", F.lit(_STEP))))
    quiet = (F.col("minute") >= K.QUIET_FROM_MINUTE) | (F.col("minute") <= K.QUIET_UNTIL_MINUTE)
    friday = (weekday == 5) & (F.col("minute") >= K.FRIDAY_CUTOFF_MINUTE)
    return rows.filter(~quiet & ~friday).select(
        *days.columns, F.col("_b.band").alias("band"),
        F.abs(F.col("minute") - F.col("_b.mid")).alias("off_mid"),
        (F.col("day").cast("timestamp_ntz") + F.make_dt_interval(
            F.lit(0), F.lit(0), F.col("minute"), F.lit(0))).alias("slot"))


def slot_candidates(starts: DataFrame, as_of: str) -> DataFrame:
    """All legal slots per distinct event start, with the widening step that reaches them."""
    offsets = F.array(*[
        F.struct(F.lit(o).alias("offset_days"), F.lit(w).alias("widening"))
        for o, w in [*((o, 0) for o in K.PREFERRED_OFFSETS),
                     *((o, i + 1) for i, o in enumerate(K.WIDENED_OFFSETS))]])
    days = starts.select("start_dt", F.explode(offsets).alias("o")).select(
        "start_dt", "o.*", F.date_sub(F.to_date("start_dt"), F.col("o.offset_days")).alias("day"))
    return _on_days(days).filter(
        (F.col("slot") >= dates.as_ntz(_earliest(as_of)))
        & (F.col("slot") <= F.col("start_dt") - F.expr("interval 24 hours")))


def slot_spacing(cands: DataFrame, queue: DataFrame) -> DataFrame:
    """Add ``gap_minutes`` to the nearest queued time (null = none within a day) and
    ``spacing_hours``: 24, 12 or 6, null when even 6 hours are not clear.

    Both sides are reduced to distinct times and lined up by day, a queued time also standing
    in the two neighbouring days; the nearest ones before and after a slot are then read off
    the order, without pairing slots and queued times.
    """
    wanted = cands.select("slot").distinct().withColumn("_day", F.to_date("slot"))
    taken = queue.filter("publish_at is not null").select(F.col("publish_at").alias("_q")).distinct()
    taken = taken.withColumn("_day", F.explode(F.transform(
        F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.date_add(F.to_date("_q"), d))))
    line = wanted.withColumn("_t", F.col("slot")).unionByName(
        taken.withColumn("_t", F.col("_q")), allowMissingColumns=True)
    day = Window.partitionBy("_day").orderBy("_t")
    before = F.last("_q", True).over(day.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.first("_q", True).over(day.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    gaps = line.withColumns({"_before": before, "_after": after}).filter("slot is not null").select(
        "slot", F.least(F.timestamp_diff("MINUTE", F.col("_before"), F.col("slot")),
                        F.timestamp_diff("MINUTE", F.col("slot"), F.col("_after"))).alias("gap_minutes"))
    gaps = gaps.filter(F.col("gap_minutes") < K.SPACING_HOURS[0] * 60)
    tier = F.when(F.col("gap_minutes").isNull(), K.SPACING_HOURS[0])
    for hours in K.SPACING_HOURS:
        tier = tier.when(F.col("gap_minutes") >= hours * 60, hours)
    return cands.join(gaps, "slot", "left").withColumn("spacing_hours", tier)


def _last_resort(starts: DataFrame, as_of: str) -> DataFrame:
    """Latest banded quarter hour a day before the start, or two hours from now rounded up."""
    limit = F.col("start_dt") - F.expr("interval 24 hours")
    days = starts.select("start_dt", F.explode(F.transform(
        F.array(F.lit(0), F.lit(1)), lambda d: F.date_sub(F.to_date(limit), d))).alias("day"))
    latest = _on_days(days).filter(F.col("slot") <= limit).groupBy("start_dt").agg(
        F.max("slot").alias("_latest"))
    soon = _earliest(as_of)
    return starts.join(latest, "start_dt", "left").select("start_dt", F.when(
        F.col("_latest") >= dates.as_ntz(soon), F.col("_latest")).otherwise(
        dates.as_ntz(_quarter_up(soon))).alias("last_resort"))


def rank_slots(articles: DataFrame, queue: DataFrame, as_of: str) -> DataFrame:
    """The chosen slot per article.

    A slot depends only on the event's start and the queue, so work is done once per distinct
    start; an article without one keeps its row and gets no slot. Order: least widening, least relaxed spacing, best band, closest to the six-day
    mark, earlier day, closest to the band's midpoint.
    """
    starts = cut_lineage(articles.filter("start_dt is not null").select("start_dt").distinct(), "starts")
    legal = slot_spacing(slot_candidates(starts, as_of), queue).filter("spacing_hours is not null")
    w = Window.partitionBy("start_dt").orderBy(
        "widening", F.desc("spacing_hours"), "band", F.abs(F.col("offset_days") - K.ANCHOR_OFFSET),
        "day", "off_mid", "slot")
    chosen = legal.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").select(
        "start_dt", "slot", "band", "offset_days", "spacing_hours", (F.col("widening") > 0).alias("widened"))
    picked = chosen.join(_last_resort(starts, as_of), "start_dt", "full_outer").select(
        "start_dt", F.coalesce("slot", "last_resort").alias("publish_at"), "band", "offset_days",
        "spacing_hours", F.coalesce("widened", F.lit(True)).alias("widened"),
        F.col("slot").isNull().alias("lead_window_missed"))
    return articles.join(picked, "start_dt", "left").withColumn(
        "lead_hours", F.timestamp_diff("HOUR", F.col("publish_at"), F.col("start_dt")))


_ASSIGNED = ("publication string, article_id string, publish_at timestamp_ntz, band int, "
             "spacing_hours int, lead_window_missed boolean")


def _assign(cands: pd.DataFrame, queue: pd.DataFrame) -> pd.DataFrame:
    """Give each of a publication's few articles a slot in turn; every pick joins the queue."""
    taken = list(queue["publish_at"].astype("datetime64[us]"))
    out = []
    for (_, article), own in cands.sort_values("turn").groupby(["turn", "article_id"], sort=True):
        slots = own["slot"].astype("datetime64[us]").to_numpy()
        gap = np.full(len(slots), np.inf)
        if taken:
            apart = np.abs(slots[:, None] - np.array(taken, dtype="datetime64[us]")[None, :])
            gap = apart.min(axis=1) / np.timedelta64(1, "h")
        hours = np.select([gap >= h for h in K.SPACING_HOURS], K.SPACING_HOURS, 0)
        ok = own.assign(hours=hours)[(hours > 0) & own["slot"].notna().to_numpy()]
        if len(ok):
            best = ok.assign(relaxed=-ok["hours"], off=(ok["offset_days"] - K.ANCHOR_OFFSET).abs()).sort_values(
                ["widening", "relaxed", "band", "off", "day", "off_mid", "slot"]).iloc[0]
            at, band, spacing, missed = best["slot"], int(best["band"]), int(best["hours"]), False
        else:
            at, band, spacing, missed = own["last_resort"].iloc[0], None, None, True
        taken.append(np.datetime64(at, "us"))
        out.append((own["publication"].iloc[0], article, at, band, spacing, missed))
    return pd.DataFrame(out, columns=[c.split()[0] for c in _ASSIGNED.split(", ")])


def assign_slots(articles: DataFrame, queue: DataFrame, as_of: str,
                 per_run: int) -> DataFrame:
    """Slots for the next articles of every publication, each pick constraining the next.

    A run takes at most ``per_run`` articles per publication, and the queue is reduced to its
    distinct times within a day of a candidate slot, so one group stays small whatever the
    backlog. Articles without a start and those that wait for a later run keep a row without a slot.
    ``articles`` (publication, article_id, relevance_avg, start_dt), ``queue`` (publication,
    publish_at).
    """
    w = Window.partitionBy("publication").orderBy(
        F.desc_nulls_last("relevance_avg"), F.asc_nulls_first("start_dt"), "article_id")
    turn = articles.filter("start_dt is not null").withColumn("turn", F.row_number().over(w)).filter(
        F.col("turn") <= per_run).select("publication", "article_id", "turn", "start_dt")
    turn = cut_lineage(turn, "turns")
    starts = turn.select("start_dt").distinct()
    choice = turn.join(_last_resort(starts, as_of), "start_dt").join(
        slot_candidates(starts, as_of), "start_dt", "left")
    days = choice.select("publication", F.to_date("slot").alias("_day")).distinct()
    near = (
        queue.select("publication", "publish_at").distinct()
        .withColumn("_day", F.explode(F.transform(
            F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.date_add(F.to_date("publish_at"), d))))
        .join(days, ["publication", "_day"], "left_semi")
        .select(F.col("publication").alias("_for"), "publish_at").distinct()
    )
    given = choice.groupBy("publication").cogroup(near.groupBy("_for")).applyInPandas(_assign, _ASSIGNED)
    waiting = articles.select("publication", "article_id").join(
        turn.select("publication", "article_id"), ["publication", "article_id"], "left_anti")
    return given.unionByName(waiting, allowMissingColumns=True)
