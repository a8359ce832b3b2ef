"""Forum text collection as Spark jobs: fetched pages in, thread listings and clean posts out."""

from threadloom.session import configure, get_spark

__all__ = ["configure", "get_spark"]
