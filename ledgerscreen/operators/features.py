"""Feature engineering for the anomaly model.

Numeric block (hour, is_weekend, day, vendor frequency, vendor spend share,
amount / account median) + one-hot indicators of department, account and
entry_type.  An indicator is a pair (column, value); it is never a column of its
own, so any number of values and any text in them will do.  Raw amount and vendor dummies are deliberately left out.  The
vendor and account statistics come from the shared ``rules.enrich`` frame,
so no aggregate is computed twice.

Ratios are rounded to 9 decimals: sums in another engine or another
partition order can differ in the last bit, and a forest split must not flip
on that.  A null hour (unparseable time) becomes -1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscreen.params import DEFAULT_PARAMS, Params

NUMERIC = ("hour", "is_weekend", "day", "vendor_frequency", "vendor_spend_share",
           "amount_vs_account_median")


def numeric_columns(e: DataFrame) -> dict:
    return {
        "hour": F.coalesce(F.col("hour"), F.lit(-1)).cast("double"),
        "is_weekend": F.coalesce(F.col("is_weekend").cast("int"), F.lit(0)).cast("double"),
        "day": F.coalesce(F.col("day"), F.lit(-1)).cast("double"),
        "vendor_frequency": F.coalesce(F.col("vendor_n"), F.lit(0)).cast("double"),
        "vendor_spend_share": F.coalesce(
            F.round(F.try_divide(F.col("vendor_sum"), F.col("total_amount")), 9), F.lit(0.0)),
        "amount_vs_account_median": F.coalesce(
            F.round(F.try_divide(F.col("amount"), F.col("acct_median")), 9), F.lit(0.0)),
    }


def model_frame(e: DataFrame, p: Params = DEFAULT_PARAMS, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: the id) + the six numeric features as ``x_<name>`` + the
    categorical columns as texts ``c_<name>``."""
    num = numeric_columns(e)
    return e.select(*(keep or ["transaction_id"]), *[num[n].alias(f"x_{n}") for n in NUMERIC],
                    *[F.col(c).cast("string").alias(f"c_{c}") for c in p.categorical_cols])


def entries(e: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """(transaction_id, feature, value): the non-zero entries of the feature matrix."""
    num = numeric_columns(e)
    cells = [F.struct(F.lit(n).alias("feature"), num[n].alias("value")) for n in NUMERIC]
    cells += [F.struct(F.concat(F.lit(f"{c}_"), F.col(c).cast("string")).alias("feature"), F.lit(1.0).alias("value"))
              for c in p.categorical_cols]
    return (e.select("transaction_id", F.explode(F.array(*cells)).alias("f")).select("transaction_id", "f.*")
            .where("feature IS NOT NULL AND value <> 0"))


def vendor_frequency(e: DataFrame) -> DataFrame:
    """G3/G4 per vendor: rows and spend share (non-null vendors)."""
    num = numeric_columns(e)
    return (e.where(F.col("vendor").isNotNull())
            .select("vendor", num["vendor_frequency"].alias("vendor_frequency"),
                    num["vendor_spend_share"].alias("vendor_spend_share"))
            .dropDuplicates(["vendor"]))
