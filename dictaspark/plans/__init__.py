"""Query catalogue: each query with its SQL twin where SQL can express it."""
