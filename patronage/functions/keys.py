"""Key normalisation.

The source database compares text case- and accent-insensitively, so stock
codes that differ only in case collide on its primary key, while pandas (and
Spark's default binary collation) keep them apart. Comparisons here are
binary by default; :func:`normalize_key` is the opt-in for sources that need
the case-insensitive behaviour on load (Spark's ``UNICODE_CI_AI`` collation
is the other route).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_key(col: Column | str) -> Column:
    """Trim surrounding whitespace and upper-case a text key."""
    col = F.col(col) if isinstance(col, str) else col
    return F.upper(F.regexp_replace(col, r"^\s+|\s+$", ""))
