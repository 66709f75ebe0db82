"""Cache footprint analytics on Spark DataFrames."""

from spoor.model import Descriptors

__all__ = ["Descriptors"]
