"""Table schemas (the ledger DDL re-expressed as StructTypes)."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_COLUMNS = (
    "transaction_id", "date", "time", "department", "account", "vendor",
    "amount", "entry_type", "posted_by", "description",
)

# Raw ledger as read from CSV: every column a string; typing happens in clean().
RAW_LEDGER = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

# Text in CSV files: a quote inside a text is doubled, blanks at its ends stay, and
# an empty text is null.
CSV_TEXT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
            "multiLine": True}

DERIVED_COLUMNS = ("day_of_week", "is_weekend", "hour", "month", "day")

CLEAN_LEDGER = T.StructType([
    T.StructField("transaction_id", T.StringType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("time", T.StringType(), True),
    T.StructField("department", T.StringType(), True),
    T.StructField("account", T.StringType(), True),
    T.StructField("vendor", T.StringType(), True),
    T.StructField("amount", T.DoubleType(), False),
    T.StructField("entry_type", T.StringType(), True),
    T.StructField("posted_by", T.StringType(), True),
    T.StructField("description", T.StringType(), True),
    T.StructField("day_of_week", T.StringType(), True),
    T.StructField("is_weekend", T.BooleanType(), True),
    T.StructField("hour", T.IntegerType(), True),
    T.StructField("month", T.IntegerType(), True),
    T.StructField("day", T.IntegerType(), True),
])
CLEAN_COLUMNS = tuple(f.name for f in CLEAN_LEDGER.fields)


def checked(df, schema: T.StructType, what: str):
    """``df`` with the columns of ``schema`` in its order, if it has them all with
    these types; otherwise a ValueError that names every difference."""
    found = {f.name: f.dataType for f in df.schema.fields}
    wrong = [f"{f.name}: {found[f.name].simpleString() if f.name in found else 'missing'}, "
             f"expected {f.dataType.simpleString()}" for f in schema.fields if found.get(f.name) != f.dataType]
    if wrong:
        raise ValueError(f"{what} does not have the ledger's columns: " + "; ".join(wrong))
    return df.select(*[f.name for f in schema.fields])


LABELS = T.StructType([
    T.StructField("transaction_id", T.StringType(), False),
    T.StructField("is_anomaly", T.IntegerType(), False),
    T.StructField("anomaly_type", T.StringType(), False),
])

RULE_FLAGS = T.StructType([
    T.StructField("transaction_id", T.StringType(), False),
    T.StructField("n_tests_triggered", T.IntegerType(), False),
    T.StructField("tests_triggered", T.StringType(), False),
    T.StructField("reasons", T.StringType(), False),
])

ML_SCORES = T.StructType([
    T.StructField("transaction_id", T.StringType(), False),
    T.StructField("ml_anomaly_score", T.DoubleType(), True),
    T.StructField("ml_flag", T.StringType(), True),
])

# One row per forest node.  feature is null on leaves; category is the value that a
# one-hot node tests, null on numeric nodes.
FOREST_MODEL = T.StructType([
    T.StructField("tree", T.IntegerType(), False),
    T.StructField("node", T.LongType(), False),
    T.StructField("depth", T.IntegerType(), False),
    T.StructField("size", T.LongType(), False),
    T.StructField("feature", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("split", T.DoubleType(), True),
    T.StructField("leaf_value", T.LongType(), True),
])

# Flat export: the risk columns followed by the cleaned ledger columns (22).
EXPORT_SCHEMA = T.StructType(
    [T.StructField("transaction_id", T.StringType(), True),
     T.StructField("n_tests_triggered", T.IntegerType(), True),
     T.StructField("tests_triggered", T.StringType(), True),
     T.StructField("reasons", T.StringType(), True),
     T.StructField("ml_anomaly_score", T.DoubleType(), True),
     T.StructField("ml_flag", T.StringType(), True),
     T.StructField("risk_score", T.DoubleType(), True),
     T.StructField("risk_level", T.StringType(), True)]
    + [T.StructField(f.name, f.dataType, True) for f in CLEAN_LEDGER.fields if f.name != "transaction_id"])
