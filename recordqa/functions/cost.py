"""Token cost of a judge call."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def call_cost(prompt_tokens: Column, completion_tokens: Column, price_in: Column, price_out: Column) -> Column:
    """USD of one call; null when a token count or a price is missing."""
    return prompt_tokens / F.lit(1000.0) * price_in + completion_tokens / F.lit(1000.0) * price_out
