"""Upper case in three forms: one call per row, one per Arrow batch, and built in."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

upper_per_row = F.udf(lambda text: None if text is None else text.upper(), T.StringType(), useArrow=False)


@F.pandas_udf(T.StringType())
def upper_per_batch(texts: pd.Series) -> pd.Series:
    return texts.str.upper()


upper_native = F.upper
