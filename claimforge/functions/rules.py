"""Claim flags and the claim category; an unknown input leaves a flag NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimforge.schemas import DENIED, HIGH_COST_ABOVE, IN_NETWORK


def is_denied(status: Column | None = None) -> Column:
    return (F.col("claim_status") if status is None else status) == DENIED


def is_high_cost() -> Column:
    return F.col("paid_amount") > HIGH_COST_ABOVE


def is_out_of_network() -> Column:
    return F.col("network_flag") != IN_NETWORK


def category() -> Column:
    """First match wins; a NULL flag falls through to the next branch."""
    kind = F.col("claim_type")
    return (
        F.when((kind == "medical") & F.col("high_cost_flag"), "high_cost_medical")
        .when(kind == "pharmacy", "pharmacy")
        .when(F.col("out_of_network_flag"), "out_of_network")
        .otherwise("standard")
    )
