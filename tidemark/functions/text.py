"""Request text: symbol lists and API request paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def symbols_text(symbols: Column) -> Column:
    """An array of symbols as the API's list text: ``A, B, C``."""
    return F.array_join(symbols, ", ")


def request_path(endpoint, symbols: Column, date_from: Column, date_to: Column) -> Column:
    """``{endpoint}?symbols=..&date_from=..&date_to=..`` for a fact request."""
    ep = endpoint if isinstance(endpoint, Column) else F.lit(endpoint)
    return F.concat(ep, F.lit("?symbols="), symbols, F.lit("&date_from="), date_from,
                    F.lit("&date_to="), date_to)
