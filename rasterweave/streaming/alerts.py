"""Alerts as rows: what a message would say, for a table sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterweave.functions.scalars import miou_band


def alert_rows(state: DataFrame) -> DataFrame:
    """state (run_id, epoch, best_e4, failed) as run_id, kind, severity, subject, next_step."""
    best = F.concat(F.lit("0."), F.lpad(F.col("best_e4").cast("string"), 4, "0"))
    subject = F.when(F.col("failed"), F.concat(F.lit("["), "run_id", F.lit("] stopped at epoch "), "epoch")).otherwise(F.concat(F.lit("["), "run_id", F.lit("] epoch "), "epoch", F.lit(", best mIoU "), best))
    return state.select(
        "run_id", F.when(F.col("failed"), "error").otherwise("progress").alias("kind"), F.when(F.col("failed"), "critical").otherwise(miou_band(F.col("best_e4") / 10000)).alias("severity"),
        subject.alias("subject"), F.when(F.col("failed"), "resume from the last checkpoint").otherwise("training goes on").alias("next_step"),
    )


def complete_rows(done: DataFrame) -> DataFrame:
    """done (run_id, step, total, best_e4, best_epoch, epochs): a folder is over, as an alert row like those of alert_rows."""
    best = F.concat(F.lit("0."), F.lpad(F.col("best_e4").cast("string"), 4, "0"))
    subject = F.concat(F.lit("["), "run_id", F.lit("] done ("), "step", F.lit("/"), "total", F.lit("), best mIoU "), best, F.lit(" at epoch "), "best_epoch", F.lit(" of "), "epochs")
    return done.select("run_id", F.lit("complete").alias("kind"), miou_band(F.col("best_e4") / 10000).alias("severity"), subject.alias("subject"), F.when(F.col("step") < F.col("total"), F.concat(F.lit("next: folder "), F.col("step") + 1)).otherwise("all folders are done").alias("next_step"))


def error_rows(failures: DataFrame) -> DataFrame:
    """failures (run_id, line_no, tail), as rows like those of alert_rows with the log's tail."""
    subject = F.concat(F.lit("["), "run_id", F.lit("] stopped at line "), "line_no")
    return failures.select("run_id", "line_no", F.lit("error").alias("kind"), F.lit("critical").alias("severity"), subject.alias("subject"), F.lit("resume from the last checkpoint").alias("next_step"), "tail")
