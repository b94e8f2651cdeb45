"""Cost and latency attribution, and the model lookup tables behind them."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

from recordqa.functions.cost import call_cost
from recordqa.functions.ids import model_spec
from recordqa.schema import CHECKS, DEFAULT_MODEL_SPEC, TOKEN_PRICES


def _literal_map(pairs) -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), v) for k, v in pairs))


def cost_column(
    provider: Column, model: Column, prompt_tokens: Column, completion_tokens: Column, prices=TOKEN_PRICES
) -> Column:
    """Cost in USD; null unless the provider is priced, the model is listed and both counts exist."""
    table = _literal_map((m, F.struct(F.lit(i).alias("i"), F.lit(o).alias("o"))) for m, i, o in prices)
    price = F.try_element_at(table, model)
    return F.when(provider == "openai", call_cost(prompt_tokens, completion_tokens, price["i"], price["o"]))


def with_cost(audit: DataFrame, prices=TOKEN_PRICES) -> DataFrame:
    """Audit rows plus ``cost_usd``. The price list is a driver-side constant, so it is a
    literal map in the plan and needs no join."""
    return audit.withColumn(
        "cost_usd",
        cost_column(F.col("provider"), F.col("model"), F.col("prompt_tokens"), F.col("completion_tokens"), prices),
    )


def routing_table(
    overrides: dict[str, str] | None = None, single_model: str | None = None
) -> dict[str, str]:
    """Model spec per check: the defaults, per-check overrides, or one model for all."""
    routing = {check: DEFAULT_MODEL_SPEC for check in CHECKS} | (overrides or {})
    if single_model:
        routing = {check: single_model for check in CHECKS}
    unknown = set(routing) - set(CHECKS)
    if unknown:
        raise ValueError(f"unknown checks in routing: {sorted(unknown)}")
    return routing


def with_routing(df: DataFrame, routing: dict[str, str]) -> DataFrame:
    """Adds ``model_spec``, ``provider`` and ``model`` for the row's ``check_name``.

    Checks without a route get nulls; an invalid spec raises.
    """
    spec = F.try_element_at(_literal_map([(c, F.lit(s)) for c, s in routing.items()]), F.col("check_name"))
    parsed = F.when(F.col("model_spec").isNotNull(), model_spec(F.col("model_spec")))
    routed = df.withColumn("model_spec", spec).withColumn("_parsed", parsed)
    return routed.withColumns({"provider": F.col("_parsed.provider"), "model": F.col("_parsed.model")}).drop("_parsed")


def attribute_call(audit: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows plus their equal share of the call's latency and cost.

    The row count per call is pre-aggregated, then joined with the call; the
    join with the rows stays open to AQE's skew split.
    """
    sizes = rows.groupBy("call_id").agg(F.count("*").alias("_n"))
    shares = audit.join(sizes, "call_id").select(
        "call_id",
        F.try_divide("latency_ms", "_n").alias("latency_ms_per_row"),
        F.try_divide("cost_usd", "_n").alias("cost_usd_per_row"),
    )
    return rows.join(shares, "call_id", "left")
