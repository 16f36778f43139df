"""Creator prospecting on Spark: discovery, enrichment, rules, drafts and contact planning."""

from scoutline.config import Settings

__all__ = ["Settings"]
