"""Running totals and maxima over a globally ordered table, without one global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wakeline.functions.timecols import floor_to

_FOLD = {"max": F.max, "sum": F.sum}


def _combine(how: str, before: Column, inside: Column) -> Column:
    if how == "max":
        return F.greatest(before, inside)  # skips nulls
    # null only when neither part has a row
    return F.coalesce(before + inside, before, inside)


def running(df: DataFrame, pos: str, how: dict[str, str], chunk: int, inclusive: bool = True) -> DataFrame:
    """Replace each column of ``how`` by its running ``max``/``sum`` in order of ``pos``.

    ``pos`` (bigint) is unique.  Rows are cut into chunks of ``chunk`` positions: each chunk is
    folded in its own task, and only one row per chunk goes through the global step, so the
    ordered single-task part is ``chunk`` times smaller than the table.  ``inclusive=False``
    leaves the current row out (null for the first).
    """
    cut = "__chunk"
    rows = df.withColumn(cut, floor_to(F.col(pos), chunk))
    totals = rows.groupBy(cut).agg(*[_FOLD[h](c).alias(f"__{c}") for c, h in how.items()])
    earlier = Window.orderBy(cut).rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(F.col(cut), *[_FOLD[h](f"__{c}").over(earlier).alias(f"__{c}") for c, h in how.items()])
    within = (Window.partitionBy(cut).orderBy(pos)
              .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1))
    kept = [c for c in df.columns if c not in how]
    inside = rows.select(cut, *kept, *[_FOLD[h](c).over(within).alias(c) for c, h in how.items()])
    return inside.join(before, cut, "left").select(
        *[_combine(how[c], F.col(f"__{c}"), F.col(c)).alias(c) if c in how else F.col(c) for c in df.columns])
