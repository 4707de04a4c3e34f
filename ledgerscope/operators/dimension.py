"""Account-dimension features (P13): account age and frequency-ranked category indices (M1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ACCOUNT, KYC_CATEGORY_COLUMNS
from ..functions.exprs import as_date, cutoff_lit
from ..session import ensure_checkpoint_dir
from .population import Population
from .ranking import exclusive_prefix


def one_row_per_account(df: DataFrame, order_cols: list[str]) -> DataFrame:
    """U3, deterministic: keep the smallest row by ``order_cols`` (nulls last) per account.

    An aggregate of ``min(struct)`` rather than a window: it has a partial step, so even a
    key with many duplicate rows never sits whole in one task.
    """
    value_cols = [c for c in df.columns if c != ACCOUNT]
    key = F.struct(
        *[x for c in order_cols for x in (F.col(c).isNull().alias(f"{c}__null"), F.col(c).alias(f"{c}__key"))],
        *[F.col(c).alias(c) for c in value_cols],
    )
    return df.groupBy(ACCOUNT).agg(F.min(key).alias("r")).select(ACCOUNT, *[F.col(f"r.{c}").alias(c) for c in value_cols])


#: bytes of a column's labels that are broadcast at most (16 more a label are counted for its rank)
LABEL_BYTES = 32 << 20


def category_ranks(df: DataFrame, columns: list[str]) -> tuple[DataFrame, dict[str, tuple[int, int]]]:
    """M1: ``column, label, idx`` (materialised): labels by frequency, ties alphabetical; and labels and bytes of each column.

    Labels are counted map-side first and ranked by buckets of their order, so any number of labels will do; what
    reaches the driver is two numbers a column.
    """
    ensure_checkpoint_dir(df.sparkSession)
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("label")) for c in columns])).alias("p")
    counts = df.select(pairs).select("p.*").where(F.col("label").isNotNull()).groupBy("column", "label").agg(F.count(F.lit(1)).alias("n")).checkpoint()
    sizes = {r["column"]: (r["labels"], r["bytes"]) for r in counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("labels"), F.sum(F.octet_length("label") + 16).alias("bytes")).collect()}
    # one order over all columns; a column's own ranks start where those of the columns before it end
    ordered = counts.select(F.struct("column", (-F.col("n")).alias("n"), "label").alias("place"), F.lit(1).alias("one"))
    ranked = exclusive_prefix(ordered, "place", ["one"])
    starts, start = [], 0
    for c in sorted(sizes):
        starts.append((c, start))
        start += sizes[c][0]
    first = F.coalesce(*[F.when(F.col("place.column") == c, F.lit(n)) for c, n in starts], F.lit(0)) if starts else F.lit(0)
    idx = (F.col("below_one") - first).cast("double")
    return ranked.select(F.col("place.column").alias("column"), F.col("place.label").alias("label"), idx.alias("idx")).checkpoint(), sizes


def with_category_indices(df: DataFrame, columns: list[str]) -> DataFrame:
    """``<column>_idx`` for each column: the label's rank; the number of labels for a null."""
    ranks, sizes = category_ranks(df, columns)
    for c in columns:
        labels, held = sizes.get(c, (0, 0))
        own = ranks.where(F.col("column") == c).select(F.col("label").alias("_label"), F.col("idx").alias("_idx"))
        own = F.broadcast(own) if held <= LABEL_BYTES else own.hint("merge")
        joined = df.join(own, F.col(c).cast("string") == F.col("_label"), "left")
        df = joined.withColumn(f"{c.lower()}_idx", F.coalesce("_idx", F.lit(float(labels)))).drop("_label", "_idx")
    return df


def kyc_features(kyc: DataFrame, cutoff_date: str, population: Population | None = None) -> DataFrame:
    """ACCOUNT_ID + account_age_days (if the open date exists) + one ``*_idx`` per category.

    Labels are ranked by their frequency in the population's kyc rows before de-duplication.
    """
    k = population.semi_join(kyc) if population is not None else kyc
    cols = [ACCOUNT]
    order = []
    if "ACCOUNT_OPEN_DATE" in k.columns:
        open_date = as_date("ACCOUNT_OPEN_DATE", k.schema["ACCOUNT_OPEN_DATE"].dataType)
        k = k.withColumn("ACCOUNT_OPEN_DATE", open_date).withColumn(
            "account_age_days", F.datediff(cutoff_lit(cutoff_date), F.col("ACCOUNT_OPEN_DATE"))
        )
        cols.append("account_age_days")
        order.append("ACCOUNT_OPEN_DATE")
    cats = [c for c in KYC_CATEGORY_COLUMNS if c in k.columns]
    if cats:
        k = with_category_indices(k, cats)
        cols += [f"{c.lower()}_idx" for c in cats]
    rows = k.select(*cols, *order)
    order += [c for c in cols if c != ACCOUNT and c != "account_age_days"]
    return one_row_per_account(rows, order).select(*cols)
