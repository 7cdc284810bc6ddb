"""Retail analytics as composable PySpark DataFrame operators."""

from tallyhouse.params import Params

__all__ = ["Params"]
