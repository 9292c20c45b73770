"""Market time-series analytics as Spark DataFrame operators."""

from tidemark.session import configure, shared_dir

__all__ = ["configure", "shared_dir"]
