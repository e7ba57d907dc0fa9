"""payguard: payment idempotency analytics as Spark jobs.

Raw payment events become one decision per payment (first sight of an
idempotency key within its time to live, or a duplicate of an earlier payment),
decisions become hourly and daily aggregates, and both layers are reconciled.
"""
