"""Human-readable byte sizes for the run manifest."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit captions of the manifest (bytes, KB, MB, GB) and their decimals.
SIZE_UNITS = ["Б", "КБ", "МБ", "ГБ"]


def human_size(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    # A tie goes to the even digit (1280 bytes are 1.2), which the format alone would not do.
    kb, mb, gb = 1024, 1024 ** 2, 1024 ** 3
    return (
        F.when(c < kb, F.format_string("%d " + SIZE_UNITS[0], c))
        .when(c < mb, F.format_string("%.1f " + SIZE_UNITS[1], F.bround(c / kb, 1)))
        .when(c < gb, F.format_string("%.2f " + SIZE_UNITS[2], F.bround(c / mb, 2)))
        .otherwise(F.format_string("%.2f " + SIZE_UNITS[3], F.bround(c / gb, 2)))
    )
