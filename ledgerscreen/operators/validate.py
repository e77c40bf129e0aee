"""Validation of the review population (High + Medium) against labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerscreen.functions.exprs import round_half_even

REVIEW = ("High", "Medium")


def labelled(risk: DataFrame, labels: DataFrame | None) -> DataFrame | None:
    """K1: risk rows left-joined to labels, missing label -> 0 / 'none'.

    ``labels`` may hold only the positive rows (equivalent after the fill, and
    small enough for AQE to broadcast at runtime)."""
    if labels is None:
        return None
    lab = labels.select("transaction_id", F.col("is_anomaly").alias("_ia"), F.col("anomaly_type").alias("_at"))
    return (risk.join(lab, "transaction_id", "left")
            .withColumn("is_anomaly", F.coalesce(F.col("_ia"), F.lit(0)))
            .withColumn("anomaly_type", F.coalesce(F.col("_at"), F.lit("none")))
            .withColumn("is_flagged", F.col("risk_level").isin(*REVIEW))
            .drop("_ia", "_at"))


def metrics(v: DataFrame) -> DataFrame:
    """K2: planted, flagged, true positives, recall and precision (0 on empty)."""
    m = v.agg(F.count_if(F.col("is_anomaly") == 1).alias("planted"),
              F.count_if(F.col("is_flagged")).alias("flagged"),
              F.count_if((F.col("is_anomaly") == 1) & F.col("is_flagged")).alias("true_positives"))
    return m.select("planted", "flagged", "true_positives",
                    F.coalesce(F.try_divide(F.col("true_positives"), F.col("planted")), F.lit(0.0)).alias("recall"),
                    F.coalesce(F.try_divide(F.col("true_positives"), F.col("flagged")), F.lit(0.0)).alias("precision"))


def threshold_sweep(v: DataFrame) -> DataFrame:
    """K2 at every cut: threshold, flagged (rows with risk_score > threshold), true_positives, recall,
    precision, f1.  Cuts are the scores that occur, and -1 (all rows).

    Scores have 4 decimals, so their histogram has at most 10,001 rows however long the
    table; one running sum over it, from the highest score down, serves all cuts."""
    hist = v.groupBy(F.col("risk_score").alias("threshold")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("is_anomaly") == 1).alias("pos"))
    none = F.lit(0).cast("long")
    hist = hist.unionByName(v.sparkSession.range(1).select(F.lit(-1.0).alias("threshold"), none.alias("n"), none.alias("pos")))
    above = Window.orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, -1)
    c = hist.select("threshold", F.coalesce(F.sum("n").over(above), none).alias("flagged"),
                    F.coalesce(F.sum("pos").over(above), none).alias("true_positives"),
                    F.sum("pos").over(Window.orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_all"))
    share = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return c.select("threshold", "flagged", "true_positives", share(F.col("true_positives"), F.col("_all")).alias("recall"),
                    share(F.col("true_positives"), F.col("flagged")).alias("precision"),
                    share(2 * F.col("true_positives"), F.col("_all") + F.col("flagged")).alias("f1"))


def recall_by_type(v: DataFrame) -> DataFrame:
    """K3: per anomaly type, share of positives flagged, in percent (1 dp)."""
    g = (v.where(F.col("is_anomaly") == 1).groupBy("anomaly_type")
         .agg(F.count(F.lit(1)).alias("n_planted"), F.count_if(F.col("is_flagged")).alias("n_caught")))
    return g.select("anomaly_type", "n_planted", "n_caught",
                    round_half_even(F.col("n_caught") / F.col("n_planted") * 100, 1).alias("recall_pct"))


def recall_one_type(v: DataFrame, kind: str = "vendor_concentration") -> DataFrame:
    """K4: recall (%) of one type; 0 when the type has no positives."""
    sub = v.where(F.col("anomaly_type") == kind)
    return sub.agg(F.count(F.lit(1)).alias("n_planted"), F.count_if(F.col("is_flagged")).alias("n_caught")).select(
        F.lit(kind).alias("anomaly_type"), "n_planted", "n_caught",
        F.coalesce(F.try_divide(F.col("n_caught") * 100.0, F.col("n_planted")), F.lit(0.0)).alias("recall_pct"))


def weakest_type(by_type: DataFrame) -> DataFrame:
    """K5: the type with the lowest recall (ties -> smallest name)."""
    return by_type.agg(
        F.min_by(F.col("anomaly_type"), F.struct(F.col("recall_pct"), F.col("anomaly_type"))).alias("weakest_type"),
        F.min("recall_pct").alias("weakest_recall_pct"))


def recall_macro(by_type: DataFrame) -> DataFrame:
    """K6: mean of the per-type recalls."""
    return by_type.agg(F.round(F.avg("recall_pct"), 4).alias("macro_recall_pct"),
                       F.count(F.lit(1)).alias("n_types"))
