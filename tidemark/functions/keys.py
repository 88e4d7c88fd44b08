"""Business keys built from parts joined by ``_``.

``concat`` (not ``concat_ws``) on purpose: a NULL part gives a NULL key, and a
NULL key never matches in a merge, exactly like the landing keys it mirrors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key(*parts) -> Column:
    cols = [p if isinstance(p, Column) else F.col(p) for p in parts]
    out = []
    for i, c in enumerate(cols):
        if i:
            out.append(F.lit("_"))
        out.append(c)
    return F.concat(*out)
