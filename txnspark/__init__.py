"""txnspark: payment-transaction analytics expressed in Spark DataFrames."""

from txnspark.session import configure, get_session

__all__ = ["configure", "get_session"]
