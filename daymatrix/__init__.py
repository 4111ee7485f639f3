"""Daily feature matrices as Spark DataFrame jobs."""

from daymatrix.model import DailyMatrix

__all__ = ["DailyMatrix"]
