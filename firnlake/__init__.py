"""A PySpark-native lakehouse table engine."""

from .lake import Lake, LakeReader, LakeWriter

__all__ = ["Lake", "LakeReader", "LakeWriter"]
