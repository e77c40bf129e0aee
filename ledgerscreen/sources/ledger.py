"""Ledger sources: raw CSV/Parquet scans and ledgers derived from the test tables.

Two derived ledgers (fixed mappings, see FIXTURES.md):

* ``ledger_from_lineitem`` -- lineitem joined to orders, customer, part and
  the supplier's nation; one journal entry per line item.
* ``ledger_from_events``   -- events joined to customer; long-tailed amounts
  and a real clock.

Joins are plain equi joins; Catalyst/AQE pick broadcast or sort-merge from the
measured sizes (nothing is hinted: at 100 TB only ``nation`` stays tiny, and the
planner sees that from statistics).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscreen.functions.exprs import hash_u32, hhmmss
from ledgerscreen.schema import CLEAN_LEDGER, CSV_TEXT, EXPORT_SCHEMA, RAW_LEDGER, checked


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def spread_if_few_partitions(df: DataFrame) -> DataFrame:
    """Round-robin the rows over every task slot when the scan has fewer partitions
    than slots.  A small file with one row group is read by one task; without
    this the joins and per-row hashing that follow would run single-threaded.
    A large table is returned unchanged: no extra shuffle."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < slots:
        return df.repartition(slots)
    return df


def csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file or folder with a header, every column a text under its header's
    name, whatever the order of the columns."""
    return spark.read.options(header=True, inferSchema=False, **CSV_TEXT).csv(path)


def load_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw ledger CSV; every column read as a string by its name (typing is done by
    ``clean`` so a bad value becomes null instead of changing a type).  A missing
    column is an error, further columns are ignored."""
    return checked(csv_rows(spark, path), RAW_LEDGER, path)


def load_export(spark: SparkSession, path: str) -> DataFrame:
    """The flat CSV export read back for the dashboard queries: typed columns,
    ``date`` parsed, and ``risk_rank`` (Low < Medium < High) for ordering."""
    from ledgerscreen.functions.exprs import risk_rank
    text = csv_rows(spark, path)
    missing = [f.name for f in EXPORT_SCHEMA.fields if f.name not in text.columns]
    if missing:
        raise ValueError(f"{path} lacks the export's columns {missing}")
    df = text.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in EXPORT_SCHEMA.fields])
    return df.withColumn("risk_rank", risk_rank(F.col("risk_level")))


def load_clean(spark: SparkSession, path: str) -> DataFrame:
    """A written cleaned ledger, checked against the table definition."""
    return checked(spark.read.parquet(path), CLEAN_LEDGER, path)


def ledger_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spread_if_few_partitions(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_linestatus", "l_shipdate"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_name")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    # Customers join the orders, which are fewer than the line items.  The other
    # dimensions are joined to the fact stream directly, so the planner
    # sizes every join from that table's own statistics (a pre-joined
    # supplier x nation gets a product-of-sizes estimate and loses broadcast);
    # the part with its long texts comes last, behind the shuffles of the others.
    sold = orders.join(cust, F.col("o_custkey") == cust.c_custkey)
    j = (li.join(sold, li.l_orderkey == F.col("o_orderkey"))
         .join(supp, li.l_suppkey == supp.s_suppkey)
         .join(nation, F.col("s_nationkey") == nation.n_nationkey)
         .join(part, li.l_partkey == part.p_partkey))
    tid = F.concat_ws("-", F.lit("JE"), F.col("l_orderkey").cast("string"),
                      F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"),
                      F.col("l_suppkey").cast("string"), F.col("l_quantity").cast("bigint").cast("string"))
    j = j.withColumn("transaction_id", tid)
    return j.select(
        "transaction_id",
        F.to_date("l_shipdate").alias("date"),
        hhmmss(hash_u32(F.col("transaction_id")) % 86400).alias("time"),
        F.col("c_mktsegment").alias("department"),
        F.col("p_type").alias("account"),
        F.col("n_name").alias("vendor"),
        F.col("l_extendedprice").alias("amount"),
        F.when(F.col("l_linestatus") == "F", "Debit").otherwise("Credit").alias("entry_type"),
        F.concat(F.lit("USER_"), (F.col("o_custkey") % 25).cast("string")).alias("posted_by"),
        F.col("p_name").alias("description"),
    )


def ledger_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = spread_if_few_partitions(table(spark, sf_dir, "events"))
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    j = ev.join(cust, ev.user_id == cust.c_custkey)
    return j.select(
        F.concat(F.lit("EV"), F.col("event_id").cast("string")).alias("transaction_id"),
        F.to_date("ts").alias("date"),
        F.date_format("ts", "HH:mm:ss").alias("time"),
        F.col("c_mktsegment").alias("department"),
        F.col("event_type").alias("account"),
        F.concat(F.lit("USER_"), F.col("user_id").cast("string")).alias("vendor"),
        F.col("value").alias("amount"),
        F.when(F.col("event_type") == "purchase", "Debit").otherwise("Credit").alias("entry_type"),
        F.concat(F.lit("USER_"), (F.col("user_id") % 25).cast("string")).alias("posted_by"),
        F.col("props").alias("description"),
    )


def dirty_ledger_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An all-text raw ledger with everything that cleaning has to mend, made of the
    given text columns of ``orders``: by the order key's remainder a field holds
    another column's text (no date, time or number), a null, a short or padded
    spelling, or a number with a suffix; every 40th row comes twice."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    date = (F.when(k % 23 == 1, F.col("o_orderpriority")).when(k % 23 == 2, F.lit(None))
            .when(k % 23 == 3, F.date_format("o_orderdate", "yyyy")).when(k % 23 == 4, F.lit("10:30:00"))
            .when(k % 23 == 5, F.date_format("o_orderdate", "yyyy-M-d"))
            .when(k % 23 == 6, F.concat(day, F.lit(" 00:00:00"))).otherwise(day))
    clock = F.concat_ws(":", (k % 24).cast("string"), F.lpad((k % 60).cast("string"), 2, "0"), F.lit("05"))
    time = (F.when(k % 19 == 1, F.col("o_orderstatus")).when(k % 19 == 2, F.lit(None))
            .when(k % 19 == 3, F.lit("23:59:60")).when(k % 19 == 4, F.lit("24:00:00"))
            .when(k % 19 == 5, F.concat(clock, F.lit(" "))).otherwise(clock))
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    amount = (F.when(k % 17 == 1, F.col("o_orderpriority")).when(k % 17 == 2, F.lit(None))
              .when(k % 17 == 3, F.concat(price, F.lit("d"))).when(k % 17 == 4, F.concat(F.lit(" "), price, F.lit(" ")))
              .when(k % 17 == 5, F.lit("1,000.00")).when(k % 17 == 6, F.lit("1e3")).otherwise(price))
    rows = o.select(
        F.when(k % 29 == 1, F.lit(None)).otherwise(F.concat(F.lit("OR"), k.cast("string"))).alias("transaction_id"),
        date.alias("date"), time.alias("time"), F.col("o_orderpriority").alias("department"),
        F.col("o_orderstatus").alias("account"), F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("vendor"),
        amount.alias("amount"), F.lit("Debit").alias("entry_type"), F.lit(None).cast("string").alias("posted_by"),
        F.col("o_orderpriority").alias("description"), F.explode(
            F.sequence(F.lit(1), F.when(k % 40 == 0, 2).otherwise(1))).alias("_copy"))
    return rows.drop("_copy")
