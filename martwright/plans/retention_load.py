"""Weekly retention loaded by increments instead of over the whole history.

A customer's second sale turns the rows of the first one from new into returning,
in weeks long past. What a customer adds to a cell (week, item) depends only on
that customer's own sales, and cells are sums over customers. So an increment
reads the sales of its own customers, and adds to each cell what they contribute
with the increment less what they contributed without it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martwright.operators import lookup, period_rank
from martwright.session import land, materialize
from martwright.sources.state_table import StateTable, summed_rows
from martwright.sources.writers import replace_period

SALES = "customer_id long, week string, item_id long, n long, revenue decimal(38,2), refunds long"
MEASURES = {
    "new_customers_count": "long",
    "returning_customers_count": "long",
    "refunded_customer_count": "long",
    "new_customers_revenue": "decimal(38,2)",
    "returning_customers_revenue": "decimal(38,2)",
    "customers_refunded": "long",
}
CELL = ["week", "item_id"]


class RetentionMart:
    """The mart and the sales per customer it follows from, in a folder."""

    def __init__(self, spark: SparkSession, path: str, strict: bool = False, buckets: int = 16) -> None:
        """``strict`` counts all rows of customers who ever refunded as refunded."""
        self.strict = strict
        keys = ["customer_id", *CELL]
        self.sales = StateTable(spark, f"{path}/sales", SALES, ["customer_id"], summed_rows(keys, ["n", "revenue", "refunds"]), keys, buckets)
        schema = "week string, item_id long, " + ", ".join(f"{m} {kind}" for m, kind in MEASURES.items())
        self.cells = StateTable(spark, f"{path}/cells", schema, ["week"], summed_rows(CELL, list(MEASURES)), CELL, buckets)

    def load(self, sales: DataFrame, days: DataFrame, batch_id: int) -> list[str]:
        """Add an increment of sales; one that comes again changes nothing. Returns the weeks whose cells have changed.

        The cells are committed before the sales: whatever is lost between, the same
        increment again finds the sales as they were.
        """
        if self.sales.has_applied(batch_id):
            return []
        refunded = F.when(F.col("status") == "refunded", 1).otherwise(0)
        added = land(
            lookup(sales, days, ["date_id"], ["week_of_year_iso"])
            .groupBy("customer_id", F.col("week_of_year_iso").alias("week"), F.col("item_id").cast("long").alias("item_id"))
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.sum(F.col("quantity") * F.col("payment_amount")).cast("decimal(38,2)").alias("revenue"),
                F.sum(refunded).cast("long").alias("refunds"),
            )
        )
        stored = self.sales.touched(added, merged=False)
        moved = self._moved(stored.withColumn("__old", F.lit(True)).unionByName(added.withColumn("__old", F.lit(False))))
        changed = self.cells.merge(moved).where(" or ".join(f"{m} <> 0" for m in MEASURES))
        changed = materialize(changed)
        if self.cells.commit(changed, batch_id):
            weeks = sorted(r.week for r in changed.select("week").distinct().collect())
        else:
            weeks = []
        self.sales.commit(added, batch_id)
        return weeks

    def _moved(self, sales: DataFrame) -> DataFrame:
        """What the cells of each customer with a new row gain: their measures of all rows less those of the ``__old`` ones.

        Rows are shuffled once, by customer; cells and totals of a customer are made where the rows are.
        """
        old, customer = F.col("__old"), Window.partitionBy("customer_id")
        sums = {"n": F.col("n"), "refunds": F.col("refunds"), "revenue": F.col("revenue")}
        cells = (
            sales.where("customer_id is not null")
            .repartition("customer_id")
            .groupBy("customer_id", *CELL)
            .agg(
                *(F.sum(value).alias(f"{name}_after") for name, value in sums.items()),
                *(F.sum(F.when(old, value)).alias(f"{name}_before") for name, value in sums.items()),
                F.max(old).alias("in_before"),
                F.lit(True).alias("in_after"),
                F.max(~old).alias("has_new"),
            )
        )
        totals = {f"{kind}_{side}": F.sum(f"{name}_{side}").over(customer) for kind, name in (("total", "n"), ("total_refunds", "refunds")) for side in ("after", "before")}
        rows = cells.withColumns({**totals, "has_new": F.max("has_new").over(customer)}).where("has_new")
        after, before = self._measures("after"), self._measures("before")
        return rows.select(*CELL, *((after[m] - before[m]).cast(kind).alias(m) for m, kind in MEASURES.items()))

    def _measures(self, side: str) -> dict[str, Column]:
        there, new = F.col(f"in_{side}"), F.col(f"total_{side}") == 1
        refunding = F.col(f"total_refunds_{side}" if self.strict else f"refunds_{side}") > 0
        revenue = F.coalesce(f"revenue_{side}", F.lit(0))
        values = {
            "new_customers_count": (new, F.lit(1)),
            "returning_customers_count": (~new, F.lit(1)),
            "refunded_customer_count": (refunding, F.lit(1)),
            "new_customers_revenue": (new, revenue),
            "returning_customers_revenue": (~new, revenue),
            "customers_refunded": (refunding, F.col(f"n_{side}" if self.strict else f"refunds_{side}")),
        }
        return {m: F.when(there & condition, value).otherwise(F.lit(0)).cast(MEASURES[m]) for m, (condition, value) in values.items()}

    def read(self, weeks: Sequence[str] | None = None) -> DataFrame:
        """Cells of the weeks, or of all, in the columns of ``customer_retention`` without the rank of the week."""
        counts = [m for m in MEASURES if m.endswith("count")]
        rows = self.cells.read()
        rows = rows if weeks is None else rows.where(F.col("week").isin(list(weeks)))
        kept = " and " if self.strict else " or "
        return rows.where(kept.join(f"{m} > 0" for m in counts)).withColumnRenamed("week", "period_name")

    def ranked(self) -> DataFrame:
        """All cells with the rank of their week."""
        return period_rank(materialize(self.read()), "period_name", "period_id")

    def publish(self, path: str, weeks: Sequence[str]) -> None:
        """Rewrite the folders of these weeks, and no others, in a table by week."""
        replace_period(self.read(weeks), path, ["period_name"], [(w,) for w in weeks])
