"""highmark: station record analytics as Spark DataFrame jobs."""

from highmark.params import RunParams
from highmark.session import build_session

__all__ = ["RunParams", "build_session"]
