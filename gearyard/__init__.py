"""Parts-inventory analytics as composable Spark DataFrame functions."""

from gearyard.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
