"""Table-in, table-out operators: geography, currency, cleaning, aggregates, KPIs, reports."""
