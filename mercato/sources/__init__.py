"""Sources and sinks: Parquet tables, derived case-study inputs, written tables."""

from mercato.sources.fixtures import Fixtures
from mercato.sources.tables import Tables

__all__ = ["Fixtures", "Tables"]
