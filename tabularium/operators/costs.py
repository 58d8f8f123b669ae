"""Cost of model calls from a usage ledger and a price table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: US dollars for a million tokens in and out, by model name.
PRICES = [
    ("gemini-2.5-pro", 1.25, 10.0),
    ("gemini-2.5-flash", 0.3, 2.5),
    ("gemini-2.5-flash-lite", 0.1, 0.4),
    ("gemini-2.0-flash", 0.1, 0.4),
    ("gemini-2.0-flash-lite", 0.075, 0.3),
    ("gemini-1.5-flash", 0.075, 0.3),
    ("gemini-1.5-pro", 1.25, 5.0),
]
MONEY = "decimal(18,10)"


def price_of(models: DataFrame, prices: DataFrame) -> DataFrame:
    """``(model, in_price, out_price)``: of each distinct model, the price with the longest name that the model's starts with.

    Only distinct models meet the price table, which is a list of a few names.
    """
    p = prices.select("name", "in_price", "out_price")
    pairs = models.select("model").distinct().join(p, F.startswith("model", "name"), "left")
    best = pairs.groupBy("model").agg(F.max_by(F.struct("in_price", "out_price"), F.length("name")).alias("p"))
    return best.select("model", "p.in_price", "p.out_price")


def priced(ledger: DataFrame, prices: DataFrame) -> DataFrame:
    """The ledger ``(stage, model, input_tokens, output_tokens)`` with ``cost_usd`` and ``pricing_known``; an unknown model costs nothing, and a call that tells no usage has a null cost."""
    rows = ledger.join(price_of(ledger, prices), "model", "left")
    part = lambda n, p: F.coalesce(F.col(n) * F.col(p).cast("decimal(12,6)") / F.lit(1_000_000), F.lit(0))
    cost = (part("input_tokens", "in_price") + part("output_tokens", "out_price")).cast(MONEY)
    cost = F.when(F.coalesce("input_tokens", "output_tokens").isNotNull(), cost)
    return rows.withColumns({"cost_usd": cost, "pricing_known": F.col("in_price").isNotNull()}).drop("in_price", "out_price")


def roll_up(costs: DataFrame) -> DataFrame:
    """``(stage, model, calls, input_tokens, output_tokens, cost_usd)``: by stage, by model and in total, in one pass. Nulls mark what is summed over."""
    return (
        costs.groupingSets([["stage"], ["model"], []], "stage", "model")
        .agg(F.count("*").alias("calls"), F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"), F.sum("cost_usd").alias("cost_usd"))
    )


def unknown_models(costs: DataFrame) -> DataFrame:
    """Distinct models without a price."""
    return costs.where(~F.col("pricing_known")).select("model").distinct()


def stage_cost(costs: DataFrame, prefix: str, price_per_call: float = 0.0) -> DataFrame:
    """One row of calls, tokens and cost of the stages that start with ``prefix``; each call may cost more, as for a search."""
    own = costs.where(F.startswith(F.col("stage"), F.lit(prefix)))
    out = own.agg(F.count("*").alias("calls"), F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("input_tokens"), F.coalesce(F.sum("output_tokens"), F.lit(0)).alias("output_tokens"), F.coalesce(F.sum("cost_usd"), F.lit(0)).alias("token_cost"))
    return out.withColumn("call_cost", (F.col("calls") * F.lit(price_per_call).cast("decimal(12,6)")).cast(MONEY))
