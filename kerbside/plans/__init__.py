"""Registered queries: inputs derived from the driver's tables, and each query with its SQL counterpart."""
