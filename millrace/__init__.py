"""DataFrame operators for everyday data-pipeline work on Spark."""

from millrace.session import build_session, checkpoint, shared_dir

__all__ = ["build_session", "checkpoint", "shared_dir"]
