"""Declared schemas and default values of the payment domain. Nothing is inferred."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_MONEY = T.DecimalType(19, 4)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S, _L, _I, _D, _B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
_TS, _DATE = T.TimestampType(), T.DateType()

RAW_RECORD = _struct(
    ("topic", _S), ("partition", _I), ("offset", _L), ("key", _S), ("value", _S), ("ingest_ts", _TS)
)
PAYMENT_EVENT = _struct(
    ("event_id", _S), ("payment_id", _S), ("account_id", _S), ("amount", _MONEY), ("currency", _S),
    ("merchant_id", _S), ("occurred_at", _TS),
)
USER_RISK_PROFILE = _struct(("user_id", _S), ("baseline_risk", _D))
FRAUD_ALERT = _struct(
    ("alert_id", _S), ("user_id", _S), ("payment_id", _S), ("score", _D), ("reasons", T.ArrayType(_S)),
    ("rule_id", _S), ("alert_date", _DATE), ("occurred_at", _TS),
)
USER_FRAUD_SCORE = _struct(("user_id", _S), ("score", _D), ("last_payment_id", _S), ("updated_at", _L))
PAYMENT_METRICS_HOURLY = _struct(
    ("window_start", _TS), ("window_end", _TS), ("metric_date", _DATE), ("currency", _S),
    ("payment_count", _L), ("total_amount", _D),
)
DEAD_LETTER = _struct(("raw", _S), ("error", _S), ("occurred_at", _TS))
PAYMENT_EVENTS_DLQ = _struct(
    ("topic", _S), ("partition", _I), ("offset", _L), ("raw_message", _S), ("error", _S), ("ingested_at", _TS)
)
SAGA_EVENT = _struct(
    ("saga_id", _S), ("saga_type", _S), ("event_type", _S), ("status", _S), ("step_name", _S),
    ("payment_id", _S), ("attempt", _I), ("event_date", _DATE), ("occurred_at", _TS),
)
SAGA_INSTANCE = _struct(
    ("id", _L), ("saga_id", _S), ("saga_type", _S), ("status", _S), ("current_step", _S), ("payload", _S),
    ("created_at", _TS), ("updated_at", _TS), ("completed_at", _TS),
)
SAGA_STEP = _struct(
    ("id", _L), ("saga_instance_id", _L), ("step_name", _S), ("step_type", _S), ("step_order", _I),
    ("status", _S), ("command_payload", _S), ("reply_payload", _S), ("error_message", _S),
    ("retry_count", _I), ("started_at", _TS), ("completed_at", _TS),
)
SAGA_REPLY = _struct(
    ("saga_id", _S), ("seq", _L), ("step_name", _S), ("status", _S), ("payload", _S), ("error_message", _S),
    ("is_compensation", _B),
)
COMPENSATION_FAILURE = _struct(
    ("saga_id", _S), ("reason", _S), ("payload", _S), ("created_at", _TS), ("resolved", _B)
)
EVENT_STORE = _struct(
    ("id", _L), ("aggregate_id", _S), ("aggregate_type", _S), ("event_type", _S), ("version", _I),
    ("account_id", _S), ("payload", _S), ("occurred_at", _TS),
)
OUTBOX = _struct(
    ("id", _L), ("partitioning_key", _S), ("type", _S), ("payload", _S), ("idempotency_key", _S),
    ("status", _S), ("created_at", _TS), ("processed_at", _TS),
)
IDEMPOTENCY_KEYS = _struct(
    ("key_hash", _S), ("request_hash", _S), ("response_body", _S), ("created_at", _TS), ("expires_at", _TS)
)
PROCESSED_COMMANDS = _struct(
    ("saga_id", _S), ("step_name", _S), ("processed_at", _TS), ("reply_payload", _S)
)
BALANCE_EVENTS = _struct(
    ("id", _L), ("source_event_id", _S), ("account_id", _S), ("currency", _S), ("delta", _MONEY),
    ("balance_after", T.DecimalType(38, 4)), ("occurred_at", _TS), ("aggregate_id", _S),
)
ACCOUNT_BALANCE = _struct(
    ("account_id", _S), ("currency", _S), ("balance", T.DecimalType(38, 4)), ("last_occurred_at", _TS),
    ("last_source_event_id", _S),
)
RULE_REGISTRY = _struct(
    ("id", _S), ("name", _S), ("enabled", _B), ("json_spec", _S), ("version", _L), ("updated_at", _TS)
)
PAYMENT_LIVE = _struct(
    ("payment_id", _S), ("account_id", _S), ("amount", _MONEY), ("currency", _S), ("merchant_id", _S),
    ("saga_id", _S), ("saga_status", _S), ("occurred_at", _TS),
)


@dataclass(frozen=True)
class FraudRule:
    """Defaults of the built-in rule."""

    rule_id: str = "rule-default"
    version: int = 1
    enabled: bool = True
    max_amount: float = 10000.0
    velocity_window_ms: int = 3_600_000
    velocity_max_count: int = 50
    structuring_threshold: float = 9900.0
    structuring_window_hours: int = 24
    structuring_min_payments: int = 3


DEFAULT_RULE = FraudRule()
DEFAULT_BASELINE_RISK = 0.1

FRAUD_RULE = _struct(
    ("rule_id", _S), ("version", _L), ("enabled", _B), ("max_amount", _D), ("velocity_window_ms", _L),
    ("velocity_max_count", _L), ("structuring_threshold", _D), ("structuring_window_hours", _L),
    ("structuring_min_payments", _L),
)

# Status names of sagas and steps, and the step types.
SAGA_STATUSES = ("STARTED", "EXECUTING", "COMPENSATING", "COMPLETED", "COMPENSATED", "FAILED")
STEP_STATUSES = ("PENDING", "EXECUTING", "COMPLETED", "FAILED", "COMPENSATING", "COMPENSATED", "SKIPPED")
STEP_TYPES = ("COMPENSABLE", "PIVOT", "RETRYABLE")


@dataclass(frozen=True)
class StepDefinition:
    name: str
    order: int
    step_type: str
    participant: str
    compensable: bool
    timeout_seconds: int
    max_retries: int
    reply_field: str
    payload_field: str


# The payment lifecycle. Only RETRYABLE steps use their retries.
PAYMENT_STEPS = (
    StepDefinition("FRAUD_CHECK", 0, "COMPENSABLE", "fraud-check", True, 10, 0, "score", "fraudScore"),
    StepDefinition("RISK_SCORING", 1, "COMPENSABLE", "risk-scoring", True, 10, 0, "score", "riskScore"),
    StepDefinition("LEDGER_APPLY", 2, "PIVOT", "ledger-apply", False, 30, 5, "ledgerEventId", "ledgerEventId"),
    StepDefinition("NOTIFY", 3, "RETRYABLE", "notification", False, 30, 3, "notificationId", "notificationId"),
)
