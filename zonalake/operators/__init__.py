"""Row-level operators: staging, validation, conforming, joining, pre-aggregation."""
