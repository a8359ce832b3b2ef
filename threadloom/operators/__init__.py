"""DataFrame operators: record extraction, filters, validation, page limits, statistics, lookups."""
