"""Small hand-made inputs, and a plain loop that decides them one by one."""

from __future__ import annotations

from datetime import datetime, timedelta

T0 = datetime(2024, 3, 1)
EVENT_COLUMNS = "payment_id string, idempotency_key string, ingested_at timestamp, kafka_partition int"


def at(hours: float = 0, **kw) -> datetime:
    return T0 + timedelta(hours=hours, **kw)


def events(spark, rows):
    """(payment_id, key, ingested_at) triples as a frame."""
    return spark.createDataFrame([(p, k, t, 0) for p, k, t in rows], EVENT_COLUMNS)


def decide_by_loop(rows, ttl=86_400, held=None):
    """Expected answer: {payment_id: (status, original)} in arrival order."""
    held = dict(held or {})
    out = {}
    for p, k, t in sorted(rows, key=lambda r: (r[2], r[0])):
        if k not in held or t >= held[k][1] + timedelta(seconds=ttl):
            held[k] = (p, t)
            out[p] = ("ACCEPTED", None)
        else:
            out[p] = ("REJECTED_DUPLICATE", held[k][0])
    return out


def decisions(df):
    return {
        r["payment_id"]: (r["dedup_status"], r["original_payment_id"])
        for r in df.select("payment_id", "dedup_status", "original_payment_id").collect()
    }
