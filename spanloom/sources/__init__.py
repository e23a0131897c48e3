"""Readers and writers: messages, tables, the lake, metrics dumps, event logs."""
