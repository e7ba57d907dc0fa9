"""Idempotency key: who paid whom how much, within which five minutes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payguard import settings as S


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def five_minute_bucket(ts: Column | str, seconds: int = S.KEY_BUCKET_SECONDS) -> Column:
    """Start of the tumbling bucket that holds the instant.

    Plain integer arithmetic on epoch seconds. ``F.window`` gives the same start
    but plans an Expand-and-filter step that blocks column-only reuse.
    """
    epoch = F.unix_seconds(_c(ts).cast("timestamp"))
    return F.timestamp_seconds(epoch - F.pmod(epoch, F.lit(seconds)))


def iso_utc(ts: Column | str, micros: bool = False) -> Column:
    """ISO-8601 in UTC with a numeric offset (``+00:00``, never ``Z``).

    Worked out from epoch numbers, so the session's time zone has no say in it.
    """
    instant = _c(ts).cast("timestamp")
    epoch = F.unix_seconds(instant)
    second = F.pmod(epoch, F.lit(86_400))
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    day = F.date_from_unix_date(((epoch - second) / 86_400).cast("int")).cast("string")
    hour, minute = F.floor(second / 3_600), F.pmod(F.floor(second / 60), F.lit(60))
    parts = [day, F.lit("T"), two(hour), F.lit(":"), two(minute), F.lit(":"), two(F.pmod(second, F.lit(60)))]
    if micros:
        parts += [F.lit("."), F.lpad(F.pmod(F.unix_micros(instant), F.lit(1_000_000)).cast("string"), 6, "0")]
    return F.concat(*parts, F.lit("+00:00"))


def amount_text(amount: Column | str) -> Column:
    """Amount with exactly four decimals, as it enters the key."""
    return _c(amount).cast("decimal(18,4)").cast("string")


def idempotency_key(
    customer_id: Column | str = "customer_id",
    merchant_id: Column | str = "merchant_id",
    amount: Column | str = "amount",
    currency: Column | str = "currency",
    event_timestamp: Column | str = "event_timestamp",
) -> Column:
    """SHA-256 hex over the five parts joined by ``|``; null if any part is null.

    ``concat`` is used rather than ``concat_ws`` since the latter would silently
    skip a null part and build a key that collides with another payment.
    """
    sep = F.lit("|")
    parts = F.concat(
        _c(customer_id), sep, _c(merchant_id), sep, amount_text(amount), sep,
        _c(currency), sep, iso_utc(five_minute_bucket(event_timestamp)),
    )
    return F.sha2(parts, 256)


def registry_key(key: Column | str = "idempotency_key") -> Column:
    return F.concat(F.lit(S.REGISTRY_PREFIX), _c(key))


def key_mismatches(events: DataFrame) -> DataFrame:
    """Events whose carried key is not the one their own fields give.

    Decisions trust the carried key; this report shows where the trust is misplaced.
    A key that cannot be recomputed counts as a mismatch.
    """
    checked = events.withColumn("recomputed_key", idempotency_key())
    return checked.filter(~F.col("idempotency_key").eqNullSafe(F.col("recomputed_key"))).select(
        "payment_id", "customer_id", "idempotency_key", "recomputed_key"
    )
