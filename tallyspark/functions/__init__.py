"""Column-level helpers: dates and periods, labels and balances, ageing, types."""
