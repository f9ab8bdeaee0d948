"""Product-catalog analytics as Spark DataFrame and Structured Streaming jobs."""

from shelfmark.schemas import Catalog
from shelfmark.session import build_session

__all__ = ["Catalog", "build_session"]
