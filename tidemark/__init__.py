"""tidemark: sensor readings and metric samples on Spark DataFrames.

Every public function takes and returns a ``DataFrame`` (or a ``Column``),
never collects, and never calls a Python UDF. Batch and streaming share the
same functions; sinks live only in ``sources`` and ``streaming``.
"""

from tidemark.session import build_session, checkpoint_root, ensure_utc

__all__ = ["build_session", "checkpoint_root", "ensure_utc"]
