"""The driver's query list and its SQL counterparts."""
