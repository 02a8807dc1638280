"""Queries of the job queue, over tables made from events; the point in time is fixed."""

from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.operators import queue as Q
from corpusmill.plans.registry import query, table

STATUS = "CASE event_type WHEN 'click' THEN 'active' WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' ELSE 'queued' END"
MADE = f"""ev AS (SELECT *, (SELECT max(ts) FROM events) AS now FROM events),
jobs AS (SELECT event_id AS id, {STATUS} AS status, props AS data, ts AS created_at, (event_id % 5)::INT AS priority, 'lock' AS lock, ts AS locked_at, (event_id % 12)::INT AS stalls, 'o' || user_id % 7 AS owner_id,
CASE WHEN event_id % 3 <> 0 THEN user_id END AS group_id, now FROM ev),
backlog AS (SELECT event_id AS id, user_id AS group_id, ts + INTERVAL 1 HOUR AS times_out_at, now FROM ev WHERE event_id % 7 = 0),
base AS (SELECT user_id AS id, CASE WHEN user_id % 4 = 0 THEN 'completed' ELSE 'active' END AS status, 'o' || user_id % 7 AS owner_id, (86400000 + user_id)::BIGINT AS ttl, min(ts) + INTERVAL 1 DAY AS expires_at, any_value(now) AS now FROM ev GROUP BY user_id),
groups AS (SELECT * FROM base UNION ALL SELECT id + 1000000000, status, owner_id, ttl, expires_at, now FROM base WHERE status = 'active')"""


def made(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    e = e.crossJoin(F.broadcast(e.agg(F.max("ts").alias("now"))))
    status = F.when(F.col("event_type") == "click", "active").when(F.col("event_type") == "purchase", "completed").when(F.col("event_type") == "error", "failed").otherwise("queued")
    owner = F.concat(F.lit("o"), (F.col("user_id") % 7).cast("string")).alias("owner_id")
    jobs = e.select(
        F.col("event_id").alias("id"), status.alias("status"), F.col("props").alias("data"), F.col("ts").alias("created_at"), (F.col("event_id") % 5).cast("int").alias("priority"), F.lit("lock").alias("lock"), F.col("ts").alias("locked_at"),
        (F.col("event_id") % 12).cast("int").alias("stalls"), owner, F.when(F.col("event_id") % 3 != 0, F.col("user_id")).alias("group_id"), "now",
    )
    backlog = e.filter("event_id % 7 = 0").select(F.col("event_id").alias("id"), F.col("user_id").alias("group_id"), (F.col("ts") + F.expr("interval 1 hour")).alias("times_out_at"), "now")
    groups = e.groupBy("user_id", "now").agg((F.min("ts") + F.expr("interval 1 day")).alias("expires_at"))
    groups = groups.select(F.col("user_id").alias("id"), F.when(F.col("user_id") % 4 == 0, "completed").otherwise("active").alias("status"), owner, (F.lit(86400000) + F.col("user_id")).cast("long").alias("ttl"), "expires_at", "now")
    # a second group for each active one, whose jobs are all done: the events have hardly a user without open ones
    done = groups.filter("status = 'active'").withColumn("id", F.col("id") + 1_000_000_000)
    groups = groups.union(done)
    return jobs, backlog, groups, F.col("now")


@query(f"WITH {MADE} SELECT id, status FROM jobs WHERE NOT coalesce((status = 'completed' AND created_at < now - INTERVAL 1 HOUR OR status = 'failed' AND created_at < now - INTERVAL 6 HOUR) AND group_id IS NULL, false)")
def queue_ttl_purge(spark, sf_dir):
    jobs, _, _, now = made(spark, sf_dir)
    return Q.purge(jobs, now).select("id", "status")


@query(f"""WITH {MADE}, l AS (SELECT *, status = 'active' AND locked_at <= now - INTERVAL 1 MINUTE AS late FROM jobs)
SELECT id, CASE WHEN late THEN CASE WHEN stalls < 9 THEN 'queued' ELSE 'failed' END ELSE status END AS status, CASE WHEN NOT late THEN lock END AS lock, (stalls + late::INT)::INT AS stalls FROM l""")
def queue_lease_reap(spark, sf_dir):
    jobs, _, _, now = made(spark, sf_dir)
    return Q.reap(jobs, now).select("id", "status", "lock", "stalls")


@query(f"WITH {MADE} SELECT id || '|failed' AS note FROM jobs WHERE status = 'active' AND locked_at <= now - INTERVAL 1 MINUTE AND stalls >= 9")
def queue_lease_failures(spark, sf_dir):
    jobs, _, _, now = made(spark, sf_dir)
    return Q.failures(jobs, now)


@query(f"WITH {MADE} SELECT id FROM backlog WHERE times_out_at >= now")
def queue_backlog_expire(spark, sf_dir):
    _, backlog, _, now = made(spark, sf_dir)
    return Q.expire_backlog(backlog, now).select("id")


DONE = "done AS (SELECT id FROM groups g WHERE status = 'active' AND NOT EXISTS (SELECT 1 FROM jobs j WHERE j.status IN ('active', 'queued') AND j.group_id = g.id) AND NOT EXISTS (SELECT 1 FROM backlog b WHERE b.group_id = g.id))"


@query(f"WITH {MADE}, {DONE} SELECT g.id, CASE WHEN d.id IS NOT NULL THEN 'completed' ELSE status END AS status, CASE WHEN d.id IS NOT NULL THEN now + to_seconds(ttl // 1000) ELSE expires_at END AS expires_at FROM groups g LEFT JOIN done d ON d.id = g.id")
def queue_group_finish(spark, sf_dir):
    jobs, backlog, groups, now = made(spark, sf_dir)
    return Q.finish_groups(groups, jobs, backlog, now)[0].select("id", "status", "expires_at")


@query(f"WITH {MADE}, {DONE} SELECT '{{}}' AS data, owner_id, id AS group_id FROM groups WHERE id IN (SELECT id FROM done)")
def queue_group_finished_jobs(spark, sf_dir):
    jobs, backlog, groups, now = made(spark, sf_dir)
    return Q.finish_groups(groups, jobs, backlog, now)[1]


@query(f"WITH {MADE}, gone AS (SELECT id FROM groups WHERE status = 'completed' AND expires_at < now) SELECT 'group' AS what, id FROM groups WHERE id NOT IN (SELECT id FROM gone) UNION ALL SELECT 'job', id FROM jobs WHERE group_id IS NULL OR group_id NOT IN (SELECT id FROM gone) UNION ALL SELECT 'backlog', id FROM backlog WHERE group_id NOT IN (SELECT id FROM gone)")
def queue_group_clean(spark, sf_dir):
    jobs, backlog, groups, now = made(spark, sf_dir)
    g, j, b = Q.clean_groups(groups, now, jobs, backlog)
    tag = lambda df, x: df.select(F.lit(x).alias("what"), "id")
    return tag(g, "group").union(tag(j, "job")).union(tag(b, "backlog"))


@query(f"WITH {MADE} SELECT id, priority FROM jobs WHERE status = 'queued' ORDER BY priority, created_at, id LIMIT 50")
def queue_dequeue_order(spark, sf_dir):
    return Q.next_jobs(made(spark, sf_dir)[0], 50).select("id", "priority")


@query(f"WITH {MADE} SELECT group_id, status, count(*) AS jobs FROM jobs WHERE id % 2 = 0 GROUP BY 1, 2")
def queue_status_counts(spark, sf_dir):
    jobs = made(spark, sf_dir)[0].withColumn("data", F.when(F.col("id") % 2 == 0, F.lit('{"mode": "single_urls"}')).otherwise(F.lit('{"mode": "crawl"}')))
    return Q.status_counts(jobs)


@query("SELECT event_id, (props->>'$.k') AS k FROM events")
def json_mode_extract(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("SELECT event_id, concat_ws(' ', event_type, 'user_id=' || user_id, 'source=\"' || CASE WHEN event_id % 2 = 0 THEN 'even' END || '\"') AS line FROM events")
def canonical_log_line(spark, sf_dir):
    source = F.when(F.col("event_id") % 2 == 0, "even")
    return table(spark, sf_dir, "events").select("event_id", T.canonical_line(F.col("event_type"), {"user_id": F.col("user_id").cast("string"), "source": T.quoted(source)}).alias("line"))
