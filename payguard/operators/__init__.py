"""Row-level and table-level building blocks."""
