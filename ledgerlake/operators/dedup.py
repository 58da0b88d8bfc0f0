"""Deterministic key dedup and append-with-dedup.

``latest_per_key`` is ``row_number() = 1`` over a total order.  Catalyst turns the
filter into a WindowGroupLimit and also runs a *partial* limit before the shuffle, so
a key with a huge number of copies is cut to one row per input partition before any
data moves: a hot key cannot pile up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(cols: Sequence) -> list[Column]:
    out = []
    for c in cols:
        out.append(F.col(c).desc_nulls_last() if isinstance(c, str) else c)
    return out


def total_order(df: DataFrame, keys: Sequence[str], leading: Sequence[str] = ()) -> list[str]:
    """``leading`` columns, then every remaining non-key column: with each compared
    descending, NULLs last, ties are broken on the whole row, so the survivor of a
    dedup never depends on how the input happened to be partitioned."""
    rest = [c for c in df.columns if c not in set(keys) and c not in set(leading)]
    return list(leading) + rest


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Keep one row per key: the first in ``order`` (Columns or names, names mean
    descending with NULLs last).  NULL keys form one group, as in dropDuplicates."""
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))


def append_new_keys(existing: DataFrame, incoming: DataFrame, keys: Sequence[str],
                    order: Sequence) -> DataFrame:
    """Rows of ``incoming`` to append to ``existing``: in-batch dedup (first row in
    ``order`` wins), then drop keys already present.  Existing rows always win.

    The anti join reads only the key columns of ``existing``.  A NULL key is a key like any
    other: once there, it is not appended again.
    """
    fresh = latest_per_key(incoming, keys, order)
    known = existing.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()
    return fresh.join(known, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], "left_anti")
