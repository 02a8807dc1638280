"""State changes of a job queue as functions of tables and a point in time.

jobs: id, status (queued, active, completed, failed), data, created_at, priority, lock, locked_at, stalls, owner_id, group_id.
groups: id, status (active, completed, cancelled), owner_id, ttl (milliseconds), expires_at."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def purge(jobs: DataFrame, now: Column) -> DataFrame:
    """Without completed jobs of more than an hour and failed ones of more than six, unless they belong to a group."""
    age = lambda s, h: (F.col("status") == s) & (F.col("created_at") < now - F.expr(f"interval {h} hours")) & F.col("group_id").isNull()
    return jobs.filter(~F.coalesce(age("completed", 1) | age("failed", 6), F.lit(False)))


def reap(jobs: DataFrame, now: Column, most_stalls: int = 9) -> DataFrame:
    """Active jobs that have been locked for a minute go back to the queue, or fail after so many stalls."""
    late = F.coalesce((F.col("status") == "active") & (F.col("locked_at") <= now - F.expr("interval 1 minute")), F.lit(False))
    stalls = F.coalesce("stalls", F.lit(0))
    return jobs.withColumns(
        {
            "status": F.when(late, F.when(stalls < most_stalls, "queued").otherwise("failed")).otherwise(F.col("status")),
            "lock": F.when(~late, F.col("lock")),
            "locked_at": F.when(~late, F.col("locked_at")),
            "stalls": F.when(late, stalls + 1).otherwise(F.col("stalls")),
        }
    )


def failures(jobs: DataFrame, now: Column, most_stalls: int = 9) -> DataFrame:
    """note: id|failed of the jobs that reap() gives up."""
    late = (F.col("status") == "active") & (F.col("locked_at") <= now - F.expr("interval 1 minute")) & (F.coalesce("stalls", F.lit(0)) >= most_stalls)
    return jobs.filter(late).select(F.concat(F.col("id").cast("string"), F.lit("|failed")).alias("note"))


def expire_backlog(backlog: DataFrame, now: Column) -> DataFrame:
    return backlog.filter(~F.coalesce(F.col("times_out_at") < now, F.lit(False)))


def finish_groups(groups: DataFrame, jobs: DataFrame, backlog: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """groups with those completed that have nothing active, queued or waiting; and a finished job for each of them."""
    busy = jobs.filter(F.col("status").isin("active", "queued")).select(F.col("group_id").alias("id")).union(backlog.select(F.col("group_id").alias("id"))).distinct()
    done = groups.filter("status = 'active'").join(busy, "id", "left_anti").select("id", F.lit(True).alias("_done"))
    whole = F.expr("make_interval(0, 0, 0, 0, 0, 0, ttl div 1000)")
    out = groups.join(done, "id", "left").withColumns({"expires_at": F.when(F.col("_done"), now + whole).otherwise(F.col("expires_at")), "status": F.when(F.col("_done"), "completed").otherwise(F.col("status"))}).drop("_done")
    return out, groups.join(done, "id", "left_semi").select(F.lit("{}").alias("data"), "owner_id", F.col("id").alias("group_id"))


def clean_groups(groups: DataFrame, now: Column, *tables: DataFrame) -> list[DataFrame]:
    """groups without completed ones that have expired, then each table without their rows."""
    gone = groups.filter((F.col("status") == "completed") & (F.col("expires_at") < now)).select(F.col("id").alias("group_id"))
    return [groups.join(gone, groups.id == gone.group_id, "left_anti"), *(t.join(gone, "group_id", "left_anti") for t in tables)]


def next_jobs(jobs: DataFrame, n: int) -> DataFrame:
    return jobs.filter("status = 'queued'").orderBy("priority", "created_at", "id").limit(n)


def finished_jobs(jobs: DataFrame) -> DataFrame:
    return jobs.filter("finished_at is not null").orderBy("finished_at", "created_at", "id")


def status_counts(jobs: DataFrame, mode: str = "single_urls") -> DataFrame:
    """group_id, status, jobs of one mode (a field of data)."""
    return jobs.filter(F.get_json_object("data", "$.mode") == mode).groupBy("group_id", "status").agg(F.count("*").alias("jobs"))
