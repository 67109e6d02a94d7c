"""The sales report kept up to date by batches: old sales are not read again.

What the report needs of the sales is additive and stored per batch:

* ``prices``: rows per (category, price), for the medians that fill missing prices;
* ``quantities``: rows per quantity, for the quartiles that bound them;
* ``sums``: rows and summed amount per (category, quantity) of sales with a price, as they are;
* ``unpriced``: rows per (category, quantity, discount) of sales without one;
* ``sales_by_quantity``: rows per (category, quantity, price, discount), in order of quantity.

A new sale can move a median or a bound. Amounts within the bounds stay as they were summed; unpriced sales are worked out from
their counts; and of the last table, whose files are in order of quantity, only quantities beyond the bounds are
read, to be clipped. The result is that of ``sales_report`` over all sales.

A batch overwrites its own partition of each table and then writes its line of the manifest; readers see
batches with such a line only, so a batch that died or came twice counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.scalars import clip, discounted_amount
from millrace.operators import cleaning
from millrace.operators.quantiles import counted_quantiles
from millrace.plans.sales_report import priced_sales, report_of_totals
from millrace.session import materialize
from millrace.streaming.logs import BATCH, committed

MONEY = "decimal(38,2)"
KEYS = {
    "prices": ("category", "unit_price"),
    "quantities": ("quantity",),
    "sums": ("category", "quantity"),
    "unpriced": ("category", "quantity", "discount"),
    "sales_by_quantity": ("category", "quantity", "unit_price", "discount"),
}


class SalesState:
    """State of the report below ``path``; ``quantity_type`` is bigint where quantities are whole."""

    def __init__(self, spark: SparkSession, path: str, quantity_type: str = "bigint") -> None:
        self.spark, self.path, self.quantity_type = spark, path.rstrip("/"), quantity_type

    def add(self, sales: DataFrame, batch_id: int) -> None:
        """One batch of raw sales; a batch that has been added before changes nothing."""
        columns = ["category", "quantity", "unit_price", "discount"]
        rows = cleaning.require_complete(priced_sales(sales.select(*columns)), ["category", "quantity", "discount"])
        rows = rows.withColumn("quantity", F.col("quantity").cast(self.quantity_type))
        cells = materialize(rows.groupBy(*columns).agg(F.count("*").alias("n")), "cells")
        priced = cells.where(F.col("unit_price").isNotNull())
        amount = discounted_amount(F.col("quantity"), F.col("unit_price"), F.col("discount")).cast(MONEY)
        parts = {"prices": priced, "quantities": cells, "unpriced": cells.where(F.col("unit_price").isNull())}
        tables = {kind: part.groupBy(*KEYS[kind]).agg(F.sum("n").alias("n")) for kind, part in parts.items()}
        tables["sums"] = priced.groupBy(*KEYS["sums"]).agg(
            F.sum("n").alias("n"), F.sum((amount * F.col("n")).cast(MONEY)).cast(MONEY).alias("amount")
        )
        tables["sales_by_quantity"] = priced.repartitionByRange("quantity").sortWithinPartitions("quantity")
        for kind, table in tables.items():
            table.write.mode("overwrite").parquet(f"{self.path}/{kind}/{BATCH}={batch_id}")
        line = cells.agg(F.lit(batch_id).cast("bigint").alias("batch_no"), F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
        line = line.select("batch_no", "total", F.col("total").alias("valid"), F.lit(0).cast("bigint").alias("invalid"))
        line.write.mode("overwrite").parquet(f"{self.path}/manifest/{BATCH}={batch_id}")

    def table(self, kind: str) -> DataFrame:
        types = {"category": "string", "quantity": self.quantity_type, "unit_price": "double", "discount": "double"}
        fields = [f"{k} {types[k]}" for k in KEYS[kind]] + ["n bigint"] + ([f"amount {MONEY}"] if kind == "sums" else [])
        schema = ", ".join([*fields, f"{BATCH} bigint"])
        return committed(self.spark, f"{self.path}/{kind}", f"{self.path}/manifest", schema)

    def medians(self) -> DataFrame:
        """Median price per category, ``_median``."""
        counts = materialize(self.table("prices").groupBy(*KEYS["prices"]).agg(F.sum("n").alias("n")), "prices")
        found = counted_quantiles(counts, "unit_price", "n", [0.5], ["category"])
        return found.select("category", F.get("quantiles", F.lit(0)).alias("_median"))

    def bounds(self) -> tuple:
        """Lowest and highest quantity that stays."""
        counts = materialize(self.table("quantities").groupBy("quantity").agg(F.sum("n").alias("n")), "quantities")
        q = counted_quantiles(counts, "quantity", "n", [0.25, 0.75])
        q1, q3 = (F.get("quantiles", F.lit(i)) for i in (0, 1))
        quartiles = q.select(F.lit("quantity").alias("column"), q1.alias("q1"), q3.alias("q3"))
        row = cleaning.iqr_bounds(counts, ["quantity"], quartiles=quartiles).select("clip_low", "clip_high").first()
        return tuple(F.lit(x).cast(self.quantity_type) for x in row)

    def report(self, top_n: int = 10) -> DataFrame:
        """The report over all committed batches, as ``sales_report`` gives it."""
        if self.table("quantities").isEmpty():
            raise ValueError("the sales table is empty")
        medians = materialize(self.medians(), "medians")
        low, high = self.bounds()
        quantity = F.col("quantity")
        clipped = clip(quantity, low, high)

        def worked_out(rows: DataFrame, price) -> DataFrame:
            amount = discounted_amount(clipped, price, F.col("discount")).cast(MONEY)
            return rows.select("category", "n", (amount * F.col("n")).cast(MONEY).alias("amount"))

        kept = self.table("sums").where(quantity.between(low, high)).select("category", "n", "amount")
        beyond = self.table("sales_by_quantity").where((quantity < low) | (quantity > high))
        missing = F.coalesce("_median", F.raise_error(F.lit("unit_price is still missing after the group median")).cast("double"))
        filled = self.table("unpriced").join(medians, "category", "left")
        parts = kept.unionByName(worked_out(beyond, F.col("unit_price"))).unionByName(worked_out(filled, missing))
        totals = parts.groupBy("category").agg(F.sum("amount").alias("amount"), F.sum("n").alias("n"), F.sum("n").alias("rows"))
        return report_of_totals(totals, top_n)
