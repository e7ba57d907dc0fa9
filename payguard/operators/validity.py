"""Which messages may enter a layer; the others leave alone, with their reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payguard import settings as S

# Column limits of the two tables (required columns have no "?").
BRONZE_LIMITS = {
    "payment_id": 64, "idempotency_key": 128, "customer_id": 64, "merchant_id": 64,
    "currency": 3, "payment_method": 32, "status": 32,
}
BRONZE_OPTIONAL_LIMITS = {"user_agent": 256, "original_payment_id": 64}
SILVER_LIMITS = {
    "payment_id": 64, "idempotency_key": 64, "customer_id": 64, "merchant_id": 64,
    "currency": 3, "payment_method": 32,
}

# An IPv4 address in four decimal parts or an IPv6 one in hexadecimal groups, with or
# without the length of a network.
_BYTE = r"(25[0-5]|2[0-4]\d|1?\d?\d)"
_GROUP = r"[0-9A-Fa-f]{1,4}"
_V4 = rf"{_BYTE}(\.{_BYTE}){{3}}"
_V6 = rf"({_GROUP}:){{7}}{_GROUP}|(?=[^.]*::)(?!.*::.*::)({_GROUP}(::?)|::){{1,7}}({_GROUP})?|({_GROUP}:)*:?:([fF]{{4}}:)?{_V4}"
ADDRESS = rf"^(({_V4})(/([12]?\d|3[0-2]))?|({_V6})(/(1[01]\d|12[0-8]|\d?\d))?)$"


def _reasons(layer: str) -> list[Column]:
    """One column per rule, null when the rule holds. Works on the decoded text."""
    bronze = layer == "bronze"
    required = BRONZE_LIMITS if bronze else SILVER_LIMITS
    optional = BRONZE_OPTIONAL_LIMITS if bronze else {}
    out = []
    for name, limit in required.items():
        out.append(F.when(F.col(name).isNull(), F.lit(f"{name} missing")))
        out.append(F.when(F.length(name) > limit, F.lit(f"{name} longer than {limit}")))
    for name, limit in optional.items():
        out.append(F.when(F.length(name) > limit, F.lit(f"{name} longer than {limit}")))
    typed = {"amount": "decimal(18,4)", "event_timestamp": "timestamp"}
    for name, to in typed.items():
        out.append(F.when(F.col(name).isNull(), F.lit(f"{name} missing")))
        out.append(F.when(F.col(name).isNotNull() & F.col(name).try_cast(to).isNull(),
                          F.lit(f"{name} not a {to.split('(')[0]}")))
    if bronze:
        for name, to in {"retry_count": "smallint", "is_retry_flag": "boolean"}.items():
            out.append(F.when(F.col(name).isNotNull() & F.col(name).try_cast(to).isNull(),
                              F.lit(f"{name} not a {to}")))
        out.append(F.when(~F.col("source_ip").rlike(ADDRESS), F.lit("source_ip not an address")))
    return out


def with_reasons(decoded: DataFrame, layer: str = "bronze") -> DataFrame:
    """Add ``invalid_reason``: all broken rules joined by ``; ``, null when valid."""
    found = F.concat_ws("; ", *_reasons(layer))
    reason = F.when(F.col("_corrupt_record").isNotNull(), F.lit("not valid JSON")).when(
        found != "", found
    )
    return decoded.withColumn("invalid_reason", reason)


def valid(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("invalid_reason").isNull()).drop("invalid_reason")


def dead_letters(checked: DataFrame) -> DataFrame:
    """Refused messages with the text as received; good neighbours are not touched."""
    return checked.filter(F.col("invalid_reason").isNotNull()).select(
        "payment_id", "invalid_reason", "raw_payload",
        *[c for c in ("ingested_at", "kafka_partition", "kafka_offset") if c in checked.columns],
    )


def invalid_decisions(checked: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Refused messages that can be named, as decisions with status invalid.

    An option of the dedup job (``record_invalid``); without it they are dead letters only.
    ``keep`` names more columns to carry.
    """
    return checked.filter(
        F.col("invalid_reason").isNotNull() & F.col("payment_id").isNotNull()
    ).select(
        "payment_id", "idempotency_key", "customer_id", "merchant_id",
        F.lit(S.REJECTED_INVALID).alias("dedup_status"),
        F.col("invalid_reason").alias("rejection_reason"),
        F.lit(None).cast("string").alias("original_payment_id"),
        *[c for c in keep if c in checked.columns],
    )
