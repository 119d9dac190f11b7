"""wavepanel: panel-survey preparation and diagnostics as Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` (use with
``df.transform``) or ``... -> Column``.  The heavy lifting is done by Spark's
own expressions, aggregates, windows and joins; there are no Python UDFs on
any hot path.
"""

from wavepanel.session import build_session, scratch_dir, ensure_checkpoint_dir

__all__ = ["build_session", "scratch_dir", "ensure_checkpoint_dir"]
