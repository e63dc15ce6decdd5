"""Member-engagement and lead analytics as Spark DataFrame operators."""

from .context import ReportContext

__all__ = ["ReportContext"]
