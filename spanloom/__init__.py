"""Span analytics for model-serving and agent traces, built on PySpark DataFrames."""

from spanloom.registry import Dimension, Registry, default_registry, load_registry
from spanloom.session import build_session, prepare, scratch_dir

__all__ = [
    "Dimension",
    "Registry",
    "build_session",
    "default_registry",
    "load_registry",
    "prepare",
    "scratch_dir",
]
