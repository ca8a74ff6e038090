"""Regenerate patronage/plans/decimal_columns.py: for every registered query,
the output columns that are DECIMAL (the driver-facing wrappers cast them to
DOUBLE on both engines) and DATE / TIMESTAMP (rendered as ISO text on both).
Run after changing a query's output types; tests/test_oracle.py checks the
file is current."""

from __future__ import annotations

import os
import pprint
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType  # noqa: E402

from patronage.plans.registry import QUERIES  # noqa: E402
from patronage.session import build_session  # noqa: E402
from patronage.sources.tables import Tables  # noqa: E402


def decimal_columns(spark, sf_dir="/root/testdata/sf0.001") -> tuple[dict, dict]:
    decimals, temporal = {}, {}
    for name, fn in sorted(QUERIES.items()):
        schema = fn(Tables.from_tpch(spark, sf_dir)).schema
        decimals[name] = [f.name for f in schema.fields if isinstance(f.dataType, DecimalType)]
        temporal[name] = [f.name for f in schema.fields
                          if isinstance(f.dataType, (DateType, TimestampType, TimestampNTZType))]
    return decimals, temporal


if __name__ == "__main__":
    decimals, temporal = decimal_columns(build_session())
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                        "patronage", "plans", "decimal_columns.py")
    with open(path, "w") as f:
        f.write('"""Generated by scripts/gen_decimal_columns.py: DECIMAL and DATE/TIMESTAMP\n'
                'output columns per query."""\n\n')
        f.write("DECIMAL_COLUMNS = " + pprint.pformat(decimals, width=100) + "\n\n")
        f.write("TEMPORAL_COLUMNS = " + pprint.pformat(temporal, width=100) + "\n")
    print(path)
