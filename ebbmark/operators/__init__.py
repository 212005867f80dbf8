"""DataFrame operators: deltas, records, day ranges, due tables, schemas."""
