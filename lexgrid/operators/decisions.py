"""What an append-only log of decisions leaves of proposed assignments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .windows import top1

BULK = 0.9  # confidence from which a bulk decision approves what is pending


def current(assigned: DataFrame, log: DataFrame, bulk: float = BULK) -> DataFrame:
    """(assignment_id, code, confidence, status) of assigned (assignment_id, code, confidence).

    log: assignment_id, kind (approve, withdraw, remap, or bulk without an id), new_code, decided_at, decision_id. The latest
    decision on an assignment holds: a remap gives it the new code, in full confidence. A later bulk decision approves those of
    confidence `bulk` or more that aren't remapped. Without any, an assignment is pending.
    """
    own = top1(log.where("kind <> 'bulk'"), ["assignment_id"], [F.desc("decided_at"), F.desc("decision_id")]).select("assignment_id", "kind", "new_code", "decided_at")
    latest = log.where("kind = 'bulk'").agg(F.max("decided_at").alias("_bulk"))
    both = assigned.join(own, "assignment_id", "left").join(latest)  # one row
    swept = (F.col("confidence") >= bulk) & F.col("_bulk").isNotNull() & (F.col("kind").isNull() | (F.col("decided_at") < F.col("_bulk")))
    remapped = F.col("kind") == "remap"
    status = F.when(remapped, "override").when(F.col("kind") == "approve", "approved").when(swept, "approved").when(F.col("kind") == "withdraw", "withdrawn").otherwise("pending")
    return both.select("assignment_id", F.when(remapped, F.col("new_code")).otherwise(F.col("code")).alias("code"), F.when(remapped, 1.0).otherwise(F.col("confidence")).cast("double").alias("confidence"), status.alias("status"))
