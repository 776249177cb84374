"""mercato: batch analytics operators for four business case studies on Spark.

Every operator is a plain function ``f(DataFrame, ..., params) -> DataFrame``
built from native Spark Column expressions, so Catalyst prunes columns,
pushes filters into the Parquet scan and plans partial aggregation.
"""

from mercato.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
