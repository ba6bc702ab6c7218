"""Column -> Column helpers; everything stays inside generated code."""

from claimforge.functions.amounts import money, rate_pct, ratio
from claimforge.functions.dates import day_span, days_since, parse_date
from claimforge.functions.privacy import digest, keyed_digest
from claimforge.functions.rules import category, is_denied, is_high_cost, is_out_of_network
from claimforge.functions.text import code_list, fold_lower, fold_upper, standard_claim_type

__all__ = [
    "category",
    "code_list",
    "day_span",
    "days_since",
    "digest",
    "fold_lower",
    "fold_upper",
    "is_denied",
    "is_high_cost",
    "is_out_of_network",
    "keyed_digest",
    "money",
    "parse_date",
    "rate_pct",
    "ratio",
    "standard_claim_type",
]
