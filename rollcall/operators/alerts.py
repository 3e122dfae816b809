"""Survey reminders: who gets one, when, which were sent, and how a project's history is reset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.schema import RECORD, SENDS_PER_ALERT, SURVEY_DONE


def eligible(surveys: DataFrame) -> DataFrame:
    """Earlier survey complete, reminder survey not."""
    text = lambda n: F.coalesce(F.col(n), F.lit(""))
    return surveys.filter(
        (text("previous_survey_complete") == SURVEY_DONE) & (text("reminder_survey_complete") != SURVEY_DONE)
    )


def schedule(
    due: DataFrame, sent: DataFrame, every_days: int, sends: int = SENDS_PER_ALERT, key: str = RECORD
) -> DataFrame:
    """Send dates for people not alerted before: ``sends`` mails, ``every_days`` apart from the run date."""
    fresh = due.join(sent.select(key), key, "left_anti")
    return (
        fresh.withColumn("send_no", F.explode(F.sequence(F.lit(0), F.lit(sends - 1))))
        .withColumn("send_date", F.date_add("run_date", F.col("send_no") * every_days))
        .withColumn("send_no", F.col("send_no") + 1)
    )


def new_sends(plan: DataFrame, ledger: DataFrame, day: str, run: int, key: str = RECORD) -> DataFrame:
    """Ledger rows (record, send number, date, run) of the planned sends that are due on ``day`` and not in the ledger yet.

    A send is known by record and number. What the same ``run`` put in before counts as not sent, so that a run
    repeated after a failure gives the same rows, which replace its own.
    """
    sent = ledger.filter(F.col("run") != run).select(key, "send_no").distinct()
    due = plan.filter(F.col("send_date").cast("date") <= F.lit(day).cast("date")).groupBy(key, "send_no").agg(F.min("send_date").alias("send_date"))
    fresh = due.join(sent, [key, "send_no"], "left_anti")
    return fresh.select(key, F.col("send_no").cast("int").alias("send_no"), F.col("send_date").cast("date").alias("send_date"), F.lit(run).cast("bigint").alias("run"))


def ledger_after(plan: DataFrame, ledger: DataFrame, day: str, run: int, key: str = RECORD) -> DataFrame:
    """The whole ledger after a run."""
    kept = ledger.filter(F.col("run") != run).select(
        key, F.col("send_no").cast("int").alias("send_no"), F.col("send_date").cast("date").alias("send_date"), F.col("run").cast("bigint").alias("run")
    )
    return kept.unionByName(new_sends(plan, ledger, day, run, key))


def reset(
    alerts: DataFrame, sent: DataFrame, recurrence: DataFrame, sent_log: DataFrame, project_id: int
) -> dict[str, tuple[DataFrame, DataFrame]]:
    """(removed, kept) of each ledger for all alerts of a project.

    All three come from one state of the ledgers, so the log rows of removed sends go too.
    """
    ids = alerts.filter(F.col("project_id") == project_id).select("alert_id")
    sends = sent.join(ids, "alert_id", "left_semi").select("alert_sent_id")
    split = lambda df, keys, on: (df.join(keys, on, "left_semi"), df.join(keys, on, "left_anti"))
    return {
        "sent": split(sent, ids, "alert_id"),
        "recurrence": split(recurrence, ids, "alert_id"),
        "sent_log": split(sent_log, sends, "alert_sent_id"),
    }
