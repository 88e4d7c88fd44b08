"""Date helpers. The session zone must be UTC (see ``session.pin_utc``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def api_day(c) -> Column:
    """API timestamp text -> ``yyyyMMdd`` text (the UTC day); NULL for junk.

    ``try_to_timestamp`` keeps junk from failing the whole job under ANSI mode,
    which is what the non-ANSI ``to_timestamp`` did. The instant is shifted so
    that rendering in the session zone shows its UTC wall clock: the day does
    not depend on where the session runs (``...T00:00:00+0000`` stays that day).
    """
    utc_wall = F.to_utc_timestamp(F.try_to_timestamp(_c(c)), F.current_timezone())
    return F.date_format(utc_wall, "yyyyMMdd")


def date_key(c) -> Column:
    """``yyyyMMdd`` text -> INT date key (NULL stays NULL)."""
    return _c(c).try_cast("int")


def int_to_date(c) -> Column:
    """INT date key ``20220706`` -> text ``2022-07-06``."""
    return F.date_format(F.to_date(_c(c).cast("string"), "yyyyMMdd"), "yyyy-MM-dd")
