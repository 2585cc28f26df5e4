"""Work queue, event and publication state as pure snapshot merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listflow import constants as K
from listflow.functions import dates, keys, structs
from listflow.operators.changes import latest_per_key
from listflow.operators.ranking import one_per_key


def work_queue(articles: DataFrame, events: DataFrame) -> DataFrame:
    """Open articles with their event."""
    return articles.filter(F.col("status").isin("queued", "in_progress")).join(events, "event_id")


def next_articles(articles: DataFrame, events: DataFrame, limit: int = K.ARTICLES_PER_RUN) -> DataFrame:
    """The next articles to work on, best score first, then soonest; ids make the order total."""
    return work_queue(articles, events).orderBy(
        F.desc_nulls_last("relevance_avg"), F.asc_nulls_first("start_dt"), "article_id").limit(limit)


def hold_queue(articles: DataFrame) -> DataFrame:
    return articles.filter("status = 'held'").orderBy(F.asc_nulls_first("updated_at"), "article_id")


def live_queue(published: DataFrame) -> DataFrame:
    return published.filter("state = 'live'").orderBy(F.asc_nulls_first("event_start_dt"), "post_id")


def by_id(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.filter(F.col(key) == F.lit(value))


def merge_events(current: DataFrame, updates: DataFrame, as_of: str, keep_existing: bool = False,
                 key: str = "event_id") -> DataFrame:
    """Full-row upsert that keeps ``created_at``.

    A column absent from an update becomes null, unless ``keep_existing``. Of several updates of
    one key, one whole row counts (see :func:`one_per_key`).
    """
    now = dates.as_ntz(as_of)
    updates = one_per_key(updates, key)
    fields = [c for c in current.columns if c not in (key, "created_at", "updated_at")]
    c = current.alias("c")
    u = updates.select(key, *[f for f in fields if f in updates.columns],
                       F.lit(True).alias("_hit")).alias("u")
    hit = F.coalesce(F.col("_hit"), F.lit(False))

    def pick(f: str) -> Column:
        new = F.col(f"u.{f}") if f in updates.columns else F.lit(None)
        new = F.coalesce(new, F.col(f"c.{f}")) if keep_existing else new
        return F.when(hit, new).otherwise(F.col(f"c.{f}")).alias(f)

    return c.join(u, key, "full_outer").select(
        key, *[pick(f) for f in fields],
        F.coalesce("c.created_at", now).alias("created_at"),
        F.when(hit, now).otherwise(F.col("c.updated_at")).alias("updated_at"))


def new_articles(events: DataFrame) -> DataFrame:
    """One queued article per event state; the id repeats when the same state comes back."""
    return events.select(
        keys.article_id(F.col("event_id"), F.col("content_hash")).alias("article_id"), "event_id",
        F.lit(K.STAGES[0]).alias("stage"), F.lit("queued").alias("status"),
        F.col("best_relevance").alias("relevance_avg"))


def insert_articles(current: DataFrame, fresh: DataFrame) -> DataFrame:
    """Insert rows whose id is not there yet, one per id."""
    unseen = one_per_key(fresh, "article_id").join(current.select("article_id"), "article_id", "left_anti")
    return current.unionByName(unseen, allowMissingColumns=True)


def patch_articles(current: DataFrame, patches: DataFrame, as_of: str) -> DataFrame:
    """Set the patched columns of matched rows; ``patches`` has one row per article."""
    fields = [c for c in patches.columns if c != "article_id"]
    p = patches.select("article_id", *[F.col(f).alias(f"_n_{f}") for f in fields],
                       F.lit(True).alias("_hit"))
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    changed = {f: F.when(hit, F.col(f"_n_{f}")).otherwise(F.col(f)) for f in fields}
    if "updated_at" in current.columns:
        changed["updated_at"] = F.when(hit, dates.as_ntz(as_of)).otherwise(F.col("updated_at"))
    return current.join(p, "article_id", "left").withColumns(changed).select(*current.columns)


def transition(articles: DataFrame, outcomes: DataFrame,
               max_attempts: int = K.MAX_ATTEMPTS) -> DataFrame:
    """Move every article that ran a stage, as one state table.

    ``articles`` (article_id, stage, status, attempts MAP, hold_stage, hold_reason);
    ``outcomes`` (article_id, kind, reason, retry_from) with kind ok, fail, infra, held, dropped.
    """
    o = outcomes.select("article_id", "kind", F.col("reason").alias("_reason"),
                        F.coalesce("retry_from", F.lit("s4_write")).alias("_retry"))
    j = articles.join(o, "article_id", "left")
    stages = F.array(*[F.lit(s) for s in K.STAGES])
    following = F.try_element_at(stages, (F.array_position(stages, F.col("stage")) + 1).cast("int"))
    attempt = F.coalesce(F.try_element_at("attempts", F.col("stage")), F.lit(0)) + 1
    kind = F.col("kind")
    spent = (kind == "fail") & (attempt >= max_attempts)
    held = (kind == "held") | spent
    return j.select(
        "article_id",
        F.when((kind == "ok") & following.isNotNull(), following)
        .when((kind == "fail") & ~spent, F.col("_retry")).otherwise(F.col("stage")).alias("stage"),
        F.when(kind == "ok", F.when(following.isNull(), "scheduled").otherwise("in_progress"))
        .when(held, "held").when(kind.isin("fail", "infra"), "queued")
        .when(kind == "dropped", "dropped").otherwise(F.col("status")).alias("status"),
        F.when(kind == "fail", structs.attempt_bump(F.col("attempts"), F.col("stage")))
        .otherwise(F.col("attempts")).alias("attempts"),
        F.when(held, F.col("stage")).otherwise(F.col("hold_stage")).alias("hold_stage"),
        F.when(spent, F.concat(F.lit("failed "), attempt, F.lit(" attempts: "), F.coalesce(
            "_reason", F.lit("stage returned not-ok"))))
        .when(kind == "held", F.col("_reason")).otherwise(F.col("hold_reason")).alias("hold_reason"))


def run_metrics(outcomes: DataFrame) -> DataFrame:
    """Counts per run; an article that was dropped or only scheduled is not published."""
    kind = F.col("kind")
    return outcomes.groupBy("run_id").agg(
        F.count_if(kind != "error").alias("processed"),
        *[F.count_if(kind == k).alias(n) for k, n in (
            ("published", "published"), ("scheduled", "scheduled"), ("dropped", "dropped"),
            ("held", "holds"), ("error", "failures"))])


def approval_sweep(articles: DataFrame, statuses: DataFrame, max_reholds: int = K.MAX_REHOLDS,
                   approved: str = "APPROVED") -> DataFrame:
    """Return approved held articles to the stage that held them, or archive them.

    ``statuses`` (article_id, review_status). The counter of that stage starts again.
    """
    j = articles.join(one_per_key(statuses.select("article_id", "review_status"), "article_id"), "article_id", "left")
    go = F.coalesce((F.col("status") == "held") & (F.upper(F.trim("review_status")) == approved),
                    F.lit(False))
    again = F.coalesce("reholds", F.lit(0)) + 1
    back = go & (again <= max_reholds)
    stage = F.coalesce("hold_stage", F.lit("s4_write"))
    return j.select(
        "article_id",
        F.when(back, stage).otherwise(F.col("stage")).alias("stage"),
        F.when(back, "queued").when(go, "archived").otherwise(F.col("status")).alias("status"),
        F.when(back, again).otherwise(F.col("reholds")).alias("reholds"),
        F.when(back, F.lit(None).cast("string")).otherwise(F.col("hold_stage")).alias("hold_stage"),
        F.when(back, structs.attempt_reset(F.col("attempts"), stage))
        .otherwise(F.col("attempts")).alias("attempts"))


def post_publish_sweep(published: DataFrame, statuses: DataFrame, as_of: str,
                       end_column: str | None = None) -> DataFrame:
    """Mark live posts whose event is over, cancelled or sold out; being over wins.

    ``statuses`` (event_id, observed). The start decides, unless ``end_column`` names the end.
    """
    over = F.col(end_column or "event_start_dt") < dates.as_ntz(as_of)
    seen = F.lower("observed")
    found = F.when(F.coalesce(over, F.lit(False)), "ended").when(
        seen.isin("cancelled", "sold_out"), seen)
    banners = F.create_map(*[F.lit(x) for item in K.BANNERS.items() for x in item])
    j = published.join(one_per_key(statuses.select("event_id", "observed"), "event_id"), "event_id", "left").withColumn(
        "new_state", F.when(F.col("state") == "live", found))
    return (j.withColumn("state", F.coalesce("new_state", "state"))
            .withColumn("banner", F.try_element_at(banners, F.col("new_state")))
            .drop("observed", "new_state"))


def record_published(current: DataFrame, fresh: DataFrame) -> DataFrame:
    """Insert or replace posts by id, in state live."""
    rows = current.withColumn("_new", F.lit(0)).unionByName(
        fresh.withColumn("state", F.lit("live")).withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return latest_per_key(rows, "post_id", F.desc("_new")).drop("_new")
