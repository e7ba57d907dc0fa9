"""What a user calls: Gold tables, incremental runs, reconciliation."""
