"""storelens: retail-operations analytics as Spark DataFrame jobs.

Every operator takes DataFrames and returns a DataFrame; nothing is
collected to the driver except size statistics used to choose a plan.
"""

from storelens.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
