"""assayloom: feature-enrichment operators for Spark DataFrames."""

from assayloom.session import build_session, materialise

__all__ = ["build_session", "materialise"]
