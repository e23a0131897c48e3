"""DataFrame operators over messages, spans and rollup states."""
