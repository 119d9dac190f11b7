"""Column expressions (scalar operators of the survey catalogue)."""

from wavepanel.functions.columns import *  # noqa: F401,F403
