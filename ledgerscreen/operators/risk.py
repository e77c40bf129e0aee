"""Risk blend: max rule severity and ML score -> risk_score and level."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerscreen.functions.exprs import blend_score, risk_bucket, severity_from_string
from ledgerscreen.params import DEFAULT_PARAMS, RULE_NAMES, SEVERITY, Params

RISK_COLUMNS = ("transaction_id", "n_tests_triggered", "tests_triggered", "reasons",
                "ml_anomaly_score", "ml_flag", "risk_score", "risk_level")


def rule_severity():
    """J4 on the reason columns: max weight over the rules a row triggered, 0 if none."""
    return F.greatest(*[F.when(F.col(f"r_{n}").isNotNull(), F.lit(SEVERITY[n])) for n in RULE_NAMES],
                      F.lit(0.0))


def with_risk(scored: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """J1-J6 on the row-aligned frame (rule summary + ML columns on the same
    rows: the reference's two left joins become no join at all)."""
    score = blend_score(F.col("rule_severity"), F.col("ml_anomaly_score"), p)
    return (scored.withColumn("ml_anomaly_score", F.coalesce(F.col("ml_anomaly_score"), F.lit(0.0)))
            .withColumn("risk_score", score)
            .withColumn("risk_level", risk_bucket(F.col("risk_score"), p)))


def risk_scores(risk: DataFrame) -> DataFrame:
    return risk.select(*RISK_COLUMNS)


def severity_table(flags: DataFrame) -> DataFrame:
    """J4 string form: severity recomputed from the names string of each flag row."""
    return flags.select("transaction_id", "tests_triggered",
                        severity_from_string(F.col("tests_triggered")).alias("rule_severity"))


def top_risk(risk: DataFrame, k: int = 10) -> DataFrame:
    """The k highest risk scores (ties broken by transaction_id)."""
    return (risk.orderBy(F.desc("risk_score"), F.asc("transaction_id")).limit(k)
            .select("transaction_id", "n_tests_triggered", "tests_triggered", "ml_anomaly_score",
                    "risk_score", "risk_level"))


def ranked(risk: DataFrame) -> DataFrame:
    """Every row with its rank, highest score first; equal scores share a rank
    (one more than the rows above them).  A score has four decimals, so the ranks
    are looked up in a table of at most 10,001 scores."""
    scores = risk.groupBy("risk_score").agg(F.count(F.lit(1)).alias("_n"))
    above = F.sum("_n").over(Window.orderBy(F.desc("risk_score")).rowsBetween(Window.unboundedPreceding, -1))
    places = scores.select(F.col("risk_score").alias("_s"), (F.coalesce(above, F.lit(0)) + 1).alias("risk_place"))
    return (risk.join(F.broadcast(places), F.col("risk_score") == F.col("_s"))
            .select("risk_place", *RISK_COLUMNS).orderBy(F.desc("risk_score"), "transaction_id"))


def level_counts(risk: DataFrame) -> DataFrame:
    """Rows per risk level."""
    return risk.groupBy("risk_level").agg(F.count(F.lit(1)).alias("n_transactions"))
