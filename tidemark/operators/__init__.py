"""Frame operators: dedup, reference data, silver, tables."""
