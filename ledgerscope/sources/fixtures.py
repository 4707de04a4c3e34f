"""Wallet-shaped inputs derived from the driver's TPC-H-ish test tables.

The test tables hold no wallet data, so five derived tables give every operator real rows:
transfers (orders x lineitem), day-end balances (events), the account dimension (customer),
labels and test ids. Each exists twice with the same meaning: as a Spark DataFrame built
from the parquet files (what the queries read) and as SQL text (what the DuckDB oracle
inlines as CTEs over its pre-registered views). Both are plain relational rewrites, so their
work grows with the input tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .normalize import RawInputs

#: fixture as-of date and label horizon end (fixed values of the fixture definition)
FIXTURE_CUTOFF = "2001-01-01"
FIXTURE_HORIZON_END = "2001-04-01"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def wallet_trx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transfers: sender = order customer, receiver = part key, type from the order priority."""
    li = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate", "l_extendedprice")
    # a shuffle join, as it would be at the scale these tables stand for (orders is not
    # broadcastable there); on small test files it also spreads the rows over the shuffle
    # partitions instead of leaving all downstream work in the one task of a single row group
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority").hint("merge")
    trx_type = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "P2P")
        .when(F.col("o_orderpriority") == "2-HIGH", "BillPay")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "MerchantPay")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Cash Out")
        .otherwise("CashIn")
    )
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
        F.col("o_custkey").alias("SRC_ACCOUNT"),
        F.col("l_partkey").alias("DST_ACCOUNT"),
        F.col("l_shipdate").alias("TRX_DATETIME"),
        F.col("l_extendedprice").alias("TRX_AMT"),
        trx_type.alias("TRX_TYPE"),
    )


def wallet_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-end balances: one month of events spread over the 90 days before the cutoff."""
    ev = _read(spark, sf_dir, "events")
    offset = (F.lit(1) + F.lit(3) * (F.lit(30) - F.dayofmonth("ts")) + F.col("event_id") % 3).cast("int")
    return (
        ev.select(
            F.col("user_id").alias("ACCOUNT_ID"),
            F.col("value").alias("V"),
            F.date_sub(F.lit(FIXTURE_CUTOFF).cast("date"), offset).alias("BAL_DATE"),
        )
        .groupBy("ACCOUNT_ID", "BAL_DATE")
        .agg((F.max("V") - F.lit(20.0)).alias("AVAILABLE_BALANCE"))
    )


def wallet_kyc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account dimension: open date = first order date, segment as gender, region name."""
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = _read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    first_order = (
        _read(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.min("o_orderdate").cast("date").alias("ACCOUNT_OPEN_DATE"))
    )
    return (
        c.join(n, c.c_nationkey == n.n_nationkey, "inner")
        .join(r, n.n_regionkey == r.r_regionkey, "inner")
        .join(first_order, first_order.o_custkey == c.c_custkey, "left")
        .select(
            F.col("c_custkey").alias("ACCOUNT_ID"),
            F.col("ACCOUNT_OPEN_DATE"),
            F.col("c_mktsegment").alias("GENDER"),
            F.col("r_name").alias("REGION"),
            F.when(F.col("c_custkey") % 10 == 9, "Merchant").otherwise("Customer").alias("ACCOUNT_TYPE"),
        )
    )


def wallet_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels: churn = no transfer in the quarter after the cutoff (fixture only)."""
    li = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    ship = F.col("l_shipdate").cast("date")
    active = (
        li.filter((ship >= F.lit(FIXTURE_CUTOFF).cast("date")) & (ship < F.lit(FIXTURE_HORIZON_END).cast("date")))
        .join(o, li.l_orderkey == o.o_orderkey, "inner")
        .select(F.col("o_custkey").alias("a"))
    )
    c = _read(spark, sf_dir, "customer").select("c_custkey").filter(F.col("c_custkey") % 5 != 0)
    return c.join(active.distinct(), c.c_custkey == active.a, "left").select(
        F.col("c_custkey").alias("ACCOUNT_ID"),
        F.when(F.col("a").isNull(), 1).otherwise(0).alias("CHURN"),
    )


def wallet_test_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _read(spark, sf_dir, "customer")
        .filter(F.col("c_custkey") % 5 == 0)
        .select(F.col("c_custkey").alias("ACCOUNT_ID"))
    )


def fixture_columns():
    from ..config import ColumnMap

    return ColumnMap(balance_date_col="BAL_DATE")


def fixture_inputs(spark: SparkSession, sf_dir: str) -> RawInputs:
    return RawInputs(
        transactions=wallet_trx(spark, sf_dir),
        balances=wallet_balance(spark, sf_dir),
        kyc=wallet_kyc(spark, sf_dir),
        labels=wallet_labels(spark, sf_dir),
        test_ids=wallet_test_ids(spark, sf_dir),
    )


# --------------------------------------------------------------------------------------
# The same five tables as SQL text, for the DuckDB oracle (CTEs over the raw table views).
# --------------------------------------------------------------------------------------

FIXTURE_SQL: dict[str, str] = {
    "wallet_trx": """
SELECT o.o_custkey AS SRC_ACCOUNT, l.l_partkey AS DST_ACCOUNT, l.l_shipdate AS TRX_DATETIME,
       l.l_extendedprice AS TRX_AMT,
       CASE o.o_orderpriority WHEN '1-URGENT' THEN 'P2P' WHEN '2-HIGH' THEN 'BillPay'
            WHEN '3-MEDIUM' THEN 'MerchantPay' WHEN '4-NOT SPECIFIED' THEN 'Cash Out'
            ELSE 'CashIn' END AS TRX_TYPE
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "wallet_balance": """
SELECT ACCOUNT_ID, BAL_DATE, MAX(V) - 20.0 AS AVAILABLE_BALANCE
FROM (SELECT user_id AS ACCOUNT_ID, value AS V,
             DATE '2001-01-01' - CAST(1 + 3 * (30 - EXTRACT(DAY FROM ts)) + event_id % 3 AS INT) AS BAL_DATE
      FROM events) e
GROUP BY ACCOUNT_ID, BAL_DATE""",
    "wallet_kyc": """
SELECT c.c_custkey AS ACCOUNT_ID, f.ACCOUNT_OPEN_DATE, c.c_mktsegment AS GENDER, r.r_name AS REGION,
       CASE WHEN c.c_custkey % 10 = 9 THEN 'Merchant' ELSE 'Customer' END AS ACCOUNT_TYPE
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN (SELECT o_custkey, CAST(MIN(o_orderdate) AS DATE) AS ACCOUNT_OPEN_DATE
           FROM orders GROUP BY o_custkey) f ON f.o_custkey = c.c_custkey""",
    "wallet_labels": """
SELECT c.c_custkey AS ACCOUNT_ID, CASE WHEN x.a IS NULL THEN 1 ELSE 0 END AS CHURN
FROM customer c
LEFT JOIN (SELECT DISTINCT o.o_custkey AS a FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
           WHERE CAST(l.l_shipdate AS DATE) >= DATE '2001-01-01'
             AND CAST(l.l_shipdate AS DATE) < DATE '2001-04-01') x ON x.a = c.c_custkey
WHERE c.c_custkey % 5 <> 0""",
    "wallet_test_ids": """
SELECT c_custkey AS ACCOUNT_ID FROM customer WHERE c_custkey % 5 = 0""",
}


def fixture_ctes() -> str:
    """``WITH`` body defining the five wallet tables (no leading WITH, no trailing comma)."""
    return ",\n".join(f"{name} AS ({sql}\n)" for name, sql in FIXTURE_SQL.items())


# --------------------------------------------------------------------------------------
# On-disk layouts of the fixture tables, for the resolution / reading / pipeline checks.
# --------------------------------------------------------------------------------------

def write_fixture_layout(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Write the five fixture tables under ``root`` the way a wallet export is laid out:
    Parquet folders for the facts, a Parquet kyc table, header CSVs for labels and test ids.
    Raw column names follow the default column map (balances use ``DATE``)."""
    raw = fixture_inputs(spark, sf_dir)
    raw.transactions.write.mode("overwrite").parquet(f"{root}/trx")
    raw.balances.withColumnRenamed("BAL_DATE", "DATE").write.mode("overwrite").parquet(f"{root}/DayEndBalance")
    raw.kyc.write.mode("overwrite").parquet(f"{root}/kyc.parquet")
    raw.labels.write.mode("overwrite").option("header", "true").csv(f"{root}/train_labels.csv")
    raw.test_ids.write.mode("overwrite").option("header", "true").csv(f"{root}/test.csv")
    return root


def write_nanos_copy(df: DataFrame, path: str, instants: bool = False) -> int:
    """Write ``df`` as Parquet with TIMESTAMP(NANOS) columns (what some exporters produce): wall-clock times, or
    instants that read the same in UTC.

    Spark itself writes microseconds, so each task converts its own batches with Arrow and
    writes one file per partition; returns the number of rows written.
    """
    import uuid

    out_schema = "rows long"
    run = uuid.uuid4().hex[:8]

    def write(batches):
        import pyarrow as pa
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq
        from pyspark import TaskContext

        fs, base = pafs.FileSystem.from_uri(path)
        fs.create_dir(base, recursive=True)
        pid = TaskContext.get().partitionId()
        writer, n = None, 0
        try:
            for pdf in batches:
                table = pa.Table.from_pandas(pdf, preserve_index=False)
                fields = [
                    pa.field(f.name, pa.timestamp("ns", tz="UTC" if instants else f.type.tz)) if pa.types.is_timestamp(f.type) else f
                    for f in table.schema
                ]
                table = table.cast(pa.schema(fields))
                if writer is None:
                    writer = pq.ParquetWriter(f"{base}/part-{pid:05d}-{run}.parquet", table.schema, filesystem=fs)
                writer.write_table(table)
                n += table.num_rows
        finally:
            if writer is not None:
                writer.close()
        import pandas as pd

        yield pd.DataFrame({"rows": [n]})

    return int(df.mapInPandas(write, out_schema).groupBy().sum("rows").first()[0] or 0)
