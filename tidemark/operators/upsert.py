"""Upsert by key (K2/K3): the MERGE of landing rows into current-state tables.

Semantics (``WHEN MATCHED UPDATE SET mapping / WHEN NOT MATCHED INSERT mapping``):

* ``mapping`` is ``{destination column: expression over the update row}``;
  update rows are projected through it and cast to the destination types.
* A destination row matched by more than one update row is an error, as in
  MERGE. Unmatched duplicates are all inserted.
* Keys compare with ``=``: a NULL key never matches, so NULL-key update rows
  are always inserted and NULL-key destination rows always kept.
* Destination columns missing from ``mapping`` keep their value on update and
  are NULL on insert.

All of it is joins: ``updates UNION ALL (destination LEFT ANTI updates)`` when
the mapping is complete. The update side is usually one run (small); the
anti-join against it is planned by AQE (broadcast when the runtime size allows).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class DuplicateMatchError(ValueError):
    """A destination row is matched by several update rows."""


def source_text(src: str | Column | None) -> str | None:
    """A mapping's source as text without the ``updates.`` spelling; None for a Column."""
    return src.strip().removeprefix("updates.") if isinstance(src, str) else None


def _expr(src: str | Column) -> Column:
    if isinstance(src, Column):
        return src
    return F.expr(source_text(src))


def _clean(name: str) -> str:
    return name.strip().strip("`")


def project_updates(updates: DataFrame, mapping: Mapping[str, str | Column],
                    dest_schema: StructType) -> DataFrame:
    """Project update rows through the mapping, cast to destination types.

    Text that is no number becomes NULL (``try_cast``) rather than failing the
    load, e.g. a landing ``yyyyMMdd`` text date into an INT ``Date``.
    """
    types = {f.name: f.dataType for f in dest_schema.fields}
    cols = []
    for dst, src in mapping.items():
        name = _clean(dst)
        if name not in types:
            raise ValueError(f"mapping targets unknown column {name!r}")
        cols.append(_expr(src).try_cast(types[name]).alias(name))
    return updates.select(*cols)


def bad_casts(mapping: Mapping[str, str | Column], dest_schema: StructType) -> list[Column]:
    """For each mapped column, the number of values that become NULL by the cast (an aggregate)."""
    types = {f.name: f.dataType for f in dest_schema.fields}
    return [F.count(F.when(_expr(src).isNotNull() & _expr(src).try_cast(types[_clean(dst)]).isNull(), 1)).alias(_clean(dst))
            for dst, src in mapping.items() if _clean(dst) in types]


def _key_cond(dest: DataFrame, upd: DataFrame, keys: Sequence[str]) -> Column:
    cond = None
    for k in keys:
        c = dest[k] == upd[k]
        cond = c if cond is None else cond & c
    return cond


def duplicate_matches(dest: DataFrame, mapped: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once among updates and also in the destination."""
    keys = list(keys)
    dup = (mapped.where(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)))
           .groupBy(*keys).count().where(F.col("count") > 1).drop("count"))
    return dup.join(dest.select(*keys), keys, "left_semi")


def fail_on_duplicate_matches(dest: DataFrame, mapped: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A branch with the destination's columns that has no rows unless a
    destination row is matched twice, in which case evaluating it fails.

    Unioned into the merged result, the check runs inside the write job: a
    failing task aborts the job before commit, so nothing is written, and the
    update side is not computed a second time by a separate action.
    """
    bad = duplicate_matches(dest, mapped, keys)
    msg = F.concat(F.lit(f"destination row matched by several update rows on {list(keys)}: "),
                   F.to_json(F.struct(*keys)))
    first, *rest = dest.schema.fields
    return bad.select(F.raise_error(msg).cast(first.dataType).alias(first.name),
                      *[F.lit(None).cast(f.dataType).alias(f.name) for f in rest])


def check_unique_matches(dest: DataFrame, mapped: DataFrame, keys: Sequence[str]) -> None:
    bad = duplicate_matches(dest, mapped, keys).limit(5).collect()
    if bad:
        raise DuplicateMatchError(
            f"{len(bad)}+ destination rows match several update rows on {list(keys)}, "
            f"e.g. {[tuple(r) for r in bad]}; deduplicate the updates first")


def merge_frames(dest: DataFrame, updates: DataFrame, keys: Sequence[str],
                 mapping: Mapping[str, str | Column], check: bool | str = True) -> DataFrame:
    """The destination after the upsert, as a DataFrame (nothing written).

    ``check``: True checks duplicate matches up front (an action); "inline"
    folds the check into the returned plan; False skips it.
    """
    keys = [_clean(k) for k in keys]
    dest_cols = dest.columns
    mapped = project_updates(updates, mapping, dest.schema)
    missing_keys = [k for k in keys if k not in mapped.columns]
    if missing_keys:
        raise ValueError(f"merge keys {missing_keys} are not mapped from the updates")
    if check is True:
        check_unique_matches(dest, mapped, keys)
    untouched = dest.join(mapped.select(*keys), keys, "left_anti")
    unmapped = [c for c in dest_cols if c not in mapped.columns]
    guard = fail_on_duplicate_matches(dest, mapped, keys) if check == "inline" else None
    if not unmapped:
        out = mapped.select(*dest_cols).unionByName(untouched.select(*dest_cols))
        return out if guard is None else out.unionByName(guard)
    # Partial mapping: matched rows keep their unmapped values, inserts get NULL.
    d = dest.select(*keys, *unmapped).alias("d")
    u = mapped.alias("u")
    joined = u.join(d, _key_cond(d, u, keys), "left")
    upserted = joined.select(*[(F.col(f"d.{c}") if c in unmapped else F.col(f"u.{c}")).alias(c)
                               for c in dest_cols])
    out = upserted.unionByName(untouched.select(*dest_cols))
    return out if guard is None else out.unionByName(guard)
