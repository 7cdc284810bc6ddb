"""Micro-batch use of the incremental operators."""
