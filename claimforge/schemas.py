"""Layer schemas, value domains and thresholds.

Fixed values: column names, their order, the accepted values and the limits
below are part of the data contract and are stated as they are.
"""

from __future__ import annotations

from pyspark.sql import types as T

TEXT = T.StringType()
DOUBLE = T.DoubleType()
DATE = T.DateType()
TIMESTAMP = T.TimestampType()
WHOLE = T.IntegerType()
FLAG = T.BooleanType()
MONEY = T.DecimalType(18, 2)
RATIO = T.DecimalType(8, 4)
SCORE = T.DecimalType(18, 6)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# claim_id and member_id are required: the extract step drops rows without them, a
# file scan itself reports every column as nullable.
RAW_CLAIMS = _schema(
    claim_id=TEXT,
    member_id=TEXT,
    provider_npi=TEXT,
    service_date=TEXT,
    discharge_date=TEXT,
    diagnosis_code=TEXT,
    procedure_code=TEXT,
    billed_amount=DOUBLE,
    allowed_amount=DOUBLE,
    paid_amount=DOUBLE,
    claim_status=TEXT,
    plan_id=TEXT,
    claim_type=TEXT,
)

STAGED_CLAIMS = _schema(
    claim_id=TEXT,
    member_id=TEXT,
    provider_npi=TEXT,
    service_date=DATE,
    discharge_date=DATE,
    diagnosis_code=TEXT,
    procedure_code=TEXT,
    billed_amount=DOUBLE,
    allowed_amount=DOUBLE,
    paid_amount=DOUBLE,
    claim_status=TEXT,
    plan_id=TEXT,
    run_date=TEXT,
    ingested_at=TIMESTAMP,
    env=TEXT,
    claim_type=TEXT,
)

MEMBERS = _schema(
    member_id=TEXT,
    plan_type=TEXT,
    group_id=TEXT,
    state=TEXT,
)
PROVIDERS = _schema(
    provider_npi=TEXT,
    provider_name=TEXT,
    specialty=TEXT,
    network_flag=TEXT,
)
DIM_MEMBERS = _schema(
    member_id=TEXT,
    age_band=TEXT,
    gender=TEXT,
    chronic_condition_flag=FLAG,
    risk_score=SCORE,
)
DIM_PROVIDERS = _schema(
    provider_npi=TEXT,
    provider_tier=TEXT,
    hospital_flag=FLAG,
    teaching_hospital_flag=FLAG,
)

DERIVED_CLAIMS = _schema(
    denied_flag=FLAG,
    high_cost_flag=FLAG,
    out_of_network_flag=FLAG,
    length_of_stay_days=WHOLE,
    cost_ratio=DOUBLE,
    service_year=WHOLE,
    service_month=WHOLE,
)

CATEGORIZED = _schema(claim_category=TEXT, days_since_service=WHOLE)

CONFORMED_CLAIMS = T.StructType(
    STAGED_CLAIMS.fields + MEMBERS.fields[1:] + PROVIDERS.fields[1:] + DERIVED_CLAIMS.fields
)

# The extract's two routes, and what its quarantine adds: rules that a row breaks.
STAGED, REJECTED = "staged", "rejected"
_BROKEN = T.ArrayType(_schema(rule=TEXT, column_name=TEXT, cell=TEXT))
NOTED = _schema(noted=_BROKEN)
REJECTED_CLAIMS = T.StructType(
    [
        *STAGED_CLAIMS.fields,
        *_schema(
            rejected=_BROKEN, noted=_BROKEN, file=TEXT, sent=_schema(service_date=TEXT, discharge_date=TEXT)
        ).fields,
    ]
)

# The warehouse fact table, in column order.
FACT_COLUMNS = [
    "claim_id",
    "member_id",
    "provider_npi",
    "service_date",
    "discharge_date",
    "diagnosis_code",
    "procedure_code",
    "billed_amount",
    "allowed_amount",
    "paid_amount",
    "claim_status",
    "claim_type",
    "plan_id",
    "denied_flag",
    "high_cost_flag",
    "out_of_network_flag",
    "length_of_stay_days",
    "cost_ratio",
    "service_year",
    "service_month",
    "provider_name",
    "specialty",
    "network_flag",
    "state",
    "ingested_at",
    "run_date",
]
FACT_CLAIMS = T.StructType([CONFORMED_CLAIMS[name] for name in FACT_COLUMNS])

# Accepted values and limits.
CLAIM_STATUSES = ["APPROVED", "DENIED", "PENDING", "ADJUSTED", "VOID"]
CLAIM_TYPES = ["medical", "pharmacy", "dental", "vision"]
STANDARD_CLAIM_TYPES = ["MEDICAL", "PHARMACY", "DENTAL", "VISION", "BEHAVIORAL"]
DENIED = "DENIED"
IN_NETWORK = "IN"
HIGH_COST_ABOVE = 10_000
# Amounts from here on do not fit the money type: such a row is invalid, as are NaN and Infinity.
AMOUNT_LIMIT = 10**16
DATE_FORMAT = "yyyy-MM-dd"
FRESHNESS_WARN_HOURS = 24
FRESHNESS_ERROR_HOURS = 48

# Partition columns of the stored layers.
STAGING_PARTITION = ["claim_type"]
CONFORMED_PARTITION = ["service_year", "service_month"]
FACT_PARTITION = ["run_date"]
MART_PARTITION = ["service_year", "service_month"]

MART_KEYS = [
    "service_year",
    "service_month",
    "plan_id",
    "claim_type",
    "claim_category",
    "state",
]

MART_CLAIMS = _schema(
    service_year=WHOLE,
    service_month=WHOLE,
    plan_id=TEXT,
    claim_type=TEXT,
    claim_category=TEXT,
    state=TEXT,
    total_claims=T.LongType(),
    unique_members=T.LongType(),
    unique_providers=T.LongType(),
    total_billed=T.DecimalType(28, 2),
    total_allowed=T.DecimalType(28, 2),
    total_paid=T.DecimalType(28, 2),
    avg_paid_per_claim=DOUBLE,
    median_paid_per_claim=DOUBLE,
    denied_claims=T.LongType(),
    high_cost_claims=T.LongType(),
    out_of_network_claims=T.LongType(),
    denial_rate_pct=DOUBLE,
    avg_los_days=DOUBLE,
    avg_cost_ratio=DOUBLE,
    avg_member_risk_score=DOUBLE,
    updated_at=TIMESTAMP,
)
