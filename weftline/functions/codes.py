"""Code-to-name mapping: native expression, vectorized UDF and row UDF.

Prefer them in that order.  The native form keeps codes it does not know; the two UDF forms
call an unknown or missing code ``Unknown``.
"""

from __future__ import annotations

from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Licence code -> operator.
LICENCE_NAMES = {
    "HV0002": "Juno",
    "HV0003": "Uber",
    "HV0004": "Via",
    "HV0005": "Lyft",
}
UNKNOWN = "Unknown"


def map_codes(column: Column | str, names: Mapping[str, str] = LICENCE_NAMES) -> Column:
    """Native mapping; other values and NULL stay as they are."""
    code = F.col(column) if isinstance(column, str) else column
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(table, code), code)


def udf_map_codes(names: Mapping[str, str] = LICENCE_NAMES):
    """A row-at-a-time UDF, also fit for ``spark.udf.register``."""
    lookup = dict(names)
    return F.udf(lambda code: lookup.get(code, UNKNOWN), "string")


def pandas_udf_map_codes(names: Mapping[str, str] = LICENCE_NAMES):
    """The same mapping over Arrow batches."""
    lookup = dict(names)

    @F.pandas_udf("string")
    def mapped(codes: pd.Series) -> pd.Series:
        return codes.map(lookup).fillna(UNKNOWN)

    return mapped
