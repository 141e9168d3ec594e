"""Support-ticket cleaning, quality checks and anomaly analytics on Spark DataFrames."""

from tidedesk.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
