"""Small results in the client process."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame


def to_client(df: DataFrame, max_rows: int) -> pd.DataFrame:
    """All rows as pandas with a fresh 0-based index; refuses results above ``max_rows``."""
    fetched = df.limit(max_rows + 1).toPandas()
    if len(fetched) > max_rows:
        raise ValueError(f"more than {max_rows} rows: write the result instead of fetching it")
    return fetched
