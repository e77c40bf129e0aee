"""Report tables (scope, top lists, histograms, the metric set) and dashboard queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerscreen.functions.exprs import risk_rank
from ledgerscreen.params import RISK_LEVELS

REVIEW = ("High", "Medium")
# FIXED VALUES -- the display columns.
DISPLAY = ("transaction_id", "date", "vendor", "account", "amount", "risk_score", "risk_level", "reasons")


def scope_metrics(risk: DataFrame) -> DataFrame:
    """L1: rows, total value and High/Medium/Low counts and shares (Low = rest)."""
    m = risk.agg(F.count(F.lit(1)).alias("n_transactions"),
                 F.round(F.sum("amount"), 2).alias("total_value"),
                 F.count_if(F.col("risk_level") == "High").alias("n_high"),
                 F.count_if(F.col("risk_level") == "Medium").alias("n_medium"))
    m = m.withColumn("n_low", F.col("n_transactions") - F.col("n_high") - F.col("n_medium"))
    pct = lambda c: F.coalesce(F.try_divide(F.col(c) * 100.0, F.col("n_transactions")), F.lit(0.0))
    return m.select("*", pct("n_high").alias("pct_high"), pct("n_medium").alias("pct_medium"),
                    pct("n_low").alias("pct_low"))


def top_vendors_flagged(risk: DataFrame, k: int = 5) -> DataFrame:
    """L2: vendors by flagged (High + Medium) value: count and sum, top k."""
    g = (risk.where(F.col("risk_level").isin(*REVIEW) & F.col("vendor").isNotNull())
         .groupBy("vendor").agg(F.count(F.lit(1)).alias("flagged_transactions"),
                                F.round(F.sum("amount"), 2).alias("flagged_value")))
    return g.orderBy(F.desc("flagged_value"), F.asc("vendor")).limit(k)


def top_transactions(risk: DataFrame, k: int = 10) -> DataFrame:
    """L3: the k highest-risk rows with the 8 display columns."""
    return risk.orderBy(F.desc("risk_score"), F.asc("transaction_id")).limit(k).select(*DISPLAY)


def monthly_value(df: DataFrame) -> DataFrame:
    """Amount per month."""
    return df.groupBy("month").agg(F.round(F.sum("amount"), 2).alias("total_value"))


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed; empty bins kept.

    Bin edges come from one 1-row aggregate; the bin table (``bins`` rows) is
    generated, so the right join is bounded."""
    x = F.col(col)
    mm = df.agg(F.min(x).alias("_mn"), F.max(x).alias("_mx"))
    width = (F.col("_mx") - F.col("_mn")) / F.lit(float(bins))
    b = F.least(F.coalesce(F.floor(F.try_divide(x - F.col("_mn"), width)), F.lit(0)), F.lit(bins - 1))
    counts = (df.where(x.isNotNull()).crossJoin(F.broadcast(mm))
              .groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n")))
    all_bins = (df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
                .crossJoin(F.broadcast(mm)))     # bins x 1 row
    return (all_bins.join(counts, "bin", "left")
            .select("bin", (F.col("_mn") + F.col("bin") * width).alias("bin_lo"),
                    (F.col("_mn") + (F.col("bin") + 1) * width).alias("bin_hi"),
                    F.coalesce(F.col("n"), F.lit(0)).alias("n")))


def level_table(spark) -> DataFrame:
    return spark.createDataFrame([(lv, i) for i, lv in enumerate(RISK_LEVELS)], "risk_level string, risk_rank int")


def risk_level_ordered(risk: DataFrame) -> DataFrame:
    """Counts for Low, Medium, High in that order, missing levels as 0."""
    counts = risk.groupBy("risk_level").agg(F.count(F.lit(1)).alias("n_transactions"))
    return (level_table(risk.sparkSession).join(counts, "risk_level", "left")
            .select("risk_level", "risk_rank", F.coalesce("n_transactions", F.lit(0)).alias("n_transactions"))
            .orderBy("risk_rank"))


def report_metrics(scope: DataFrame, valid: DataFrame | None, vendor_recall: DataFrame | None,
                   benford_flag: DataFrame) -> DataFrame:
    """Every number the findings report prints, as (section, metric, value)."""
    def long(df: DataFrame, section: str, cols: list[str]) -> DataFrame:
        return df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
            [], cols, "metric", "value").select(F.lit(section).alias("section"), "metric", "value")
    out = long(scope, "scope", ["n_transactions", "total_value", "n_high", "n_medium", "n_low",
                                "pct_high", "pct_medium", "pct_low"])
    if valid is not None:
        out = out.unionByName(long(valid, "validation",
                                   ["planted", "flagged", "true_positives", "recall", "precision"]))
    if vendor_recall is not None:
        out = out.unionByName(long(vendor_recall, "vendor_concentration", ["recall_pct"]))
    out = out.unionByName(long(benford_flag.withColumn("all_review", F.col("all_review").cast("int")),
                               "benford", ["n_accounts", "n_review", "all_review"]))
    return out


# ---------------------------------------------------------------- dashboard

def dashboard_filter(departments: list[str] | None = None, levels: list[str] | None = ("Medium", "High"),
                     months: tuple[int, int] = (1, 12)) -> Column:
    """M1: department IN (empty = all) AND level IN (empty = all) AND month in range."""
    pred = F.col("month").between(months[0], months[1])
    if departments:
        pred = pred & F.col("department").isin(*departments)
    if levels:
        pred = pred & F.col("risk_level").isin(*levels)
    return pred


def dash_kpis(export: DataFrame) -> DataFrame:
    """M2 (unfiltered data)."""
    return export.agg(F.count(F.lit(1)).alias("n_transactions"),
                      F.round(F.sum("amount"), 2).alias("total_value"),
                      F.count_if(F.col("risk_level") == "High").alias("n_high"),
                      F.count_if(F.col("risk_level") == "Medium").alias("n_medium"),
                      F.count_distinct("vendor").alias("n_vendors"))


def dash_rule_counts(export: DataFrame) -> DataFrame:
    """M3: per rule, flagged rows, with a display label (underscores -> spaces, title case)."""
    t = F.col("tests_triggered")
    names = export.where(t.isNotNull() & (t != "")).select(F.explode(F.split(t, ", ")).alias("test_name"))
    return (names.groupBy("test_name").agg(F.count(F.lit(1)).alias("n_flagged"))
            .select("test_name", F.initcap(F.replace(F.col("test_name"), F.lit("_"), F.lit(" "))).alias("label"),
                    "n_flagged").orderBy("n_flagged", "test_name"))


def dash_vendor_risk(export: DataFrame, k: int = 10) -> DataFrame:
    """M4: top k vendors by flagged value."""
    g = (export.where(F.col("risk_level").isin(*REVIEW) & F.col("vendor").isNotNull())
         .groupBy("vendor").agg(F.round(F.sum("amount"), 2).alias("flagged_value")))
    return g.orderBy(F.desc("flagged_value"), F.asc("vendor")).limit(k)


def dash_vendor_scatter(export: DataFrame) -> DataFrame:
    """M5: per row (risk_level, vendor_frequency, amount)."""
    return export.select("transaction_id", "risk_level", "vendor_frequency", "amount")


def dash_dept_spend(export: DataFrame) -> DataFrame:
    """M6: spend by department."""
    return (export.where(F.col("department").isNotNull()).groupBy("department")
            .agg(F.round(F.sum("amount"), 2).alias("total_spend")).orderBy(F.desc("total_spend"), "department"))


def fmt_score3(score: Column) -> Column:
    """risk_score as text with 3 decimals, half up, from exact basis points."""
    bp = F.round(score * 10000).cast("bigint")
    k = F.floor((bp + F.lit(5)) / F.lit(10)).cast("bigint")
    return F.concat((k / 1000).cast("bigint").cast("string"), F.lit("."),
                    F.lpad((k % 1000).cast("string"), 3, "0"))


def dash_detail(export: DataFrame, pred: Column) -> DataFrame:
    """M7: filtered High/Medium rows, 8 formatted display columns."""
    rows = export.where(pred & F.col("risk_level").isin(*REVIEW))
    return rows.select(
        "transaction_id", F.date_format("date", "yyyy-MM-dd").alias("date"), "vendor", "account",
        F.concat(F.lit("₹"), F.format_number("amount", 2)).alias("amount"),
        fmt_score3(F.col("risk_score")).alias("risk_score"), "risk_level", "reasons",
        F.col("risk_score").alias("_sort")).orderBy(F.desc("_sort"), F.asc("transaction_id")).drop("_sort")


def dash_departments(export: DataFrame) -> DataFrame:
    """M8: sorted distinct departments."""
    return export.where(F.col("department").isNotNull()).select("department").distinct().orderBy("department")

