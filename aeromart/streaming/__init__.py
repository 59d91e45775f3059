"""Incremental loads with Structured Streaming, and the gated bronze-to-gold run."""

from .gated import run_pipeline
from .incremental import load_csv_once, run_incremental

__all__ = ["load_csv_once", "run_incremental", "run_pipeline"]
