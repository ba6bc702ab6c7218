"""Reference attributes and derived claim columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimforge.functions import (
    category,
    day_span,
    days_since,
    fold_upper,
    is_denied,
    is_high_cost,
    is_out_of_network,
    ratio,
)
from claimforge.operators.lookup import lookup
from claimforge.schemas import DIM_MEMBERS, DIM_PROVIDERS, MEMBERS, PROVIDERS

# Claims are unique on their id once old copies are gone; the other keys tell copies apart.
SPREAD_BY = ("claim_id", "member_id", "provider_npi")


def attach_reference(
    claims: DataFrame,
    members: DataFrame,
    providers: DataFrame,
    hot: dict[str, list] | None = None,
) -> DataFrame:
    """Plan, group, state and provider attributes; claims without a match stay.

    ``hot`` lists heavy member and provider keys, as ``hot_keys`` reports them.
    Members come first, here and in ``attach_dimensions``: theirs is the dimension too
    large to broadcast, and so the claims move before they have the providers' names.
    Where the providers are broadcast, a second member join in the same plan finds the
    claims already placed by member.
    """
    keys = [MEMBERS.names[0], PROVIDERS.names[0]]
    others = [name for name in claims.columns if name not in keys]
    for dim, schema in ((members, MEMBERS), (providers, PROVIDERS)):
        claims = _attach(claims, dim, schema.names, hot)
    return claims.select(*keys, *others, *PROVIDERS.names[1:], *MEMBERS.names[1:])


def _attach(
    claims: DataFrame, dim: DataFrame, names: list[str], hot: dict[str, list] | None
) -> DataFrame:
    key = names[0]
    return lookup(claims, dim.select(*names), key, (hot or {}).get(key, ()), SPREAD_BY)


def derive(df: DataFrame, normalize_first: bool = False) -> DataFrame:
    """The seven derived columns, in one projection.

    The denied flag reads the status as stored; ``normalize_first`` trims and
    upper-cases it for the comparison.
    """
    status = fold_upper("claim_status") if normalize_first else None
    return df.withColumns(
        {
            "denied_flag": is_denied(status),
            "high_cost_flag": is_high_cost(),
            "out_of_network_flag": is_out_of_network(),
            "length_of_stay_days": day_span("service_date", "discharge_date"),
            "cost_ratio": ratio("paid_amount", "billed_amount"),
            "service_year": F.year("service_date"),
            "service_month": F.month("service_date"),
        }
    )


def attach_dimensions(
    claims: DataFrame,
    dim_members: DataFrame | None,
    dim_providers: DataFrame | None,
    hot: dict[str, list] | None = None,
) -> DataFrame:
    """Warehouse dimension attributes for staged claims.

    An outer join cannot be dropped by the optimizer when its columns go unused, so
    a caller that needs nothing from a dimension passes ``None`` for it.
    """
    for dim, schema in ((dim_members, DIM_MEMBERS), (dim_providers, DIM_PROVIDERS)):
        if dim is not None:
            claims = _attach(claims, dim, schema.names, hot)
    return claims


def categorize(df: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    return df.withColumns(
        {"claim_category": category(), "days_since_service": days_since("service_date", as_of)}
    )
