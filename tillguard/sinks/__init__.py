"""Writers: idempotent appends, overwrites, alert and score tables, keyed JSON."""
