"""Broadcast only what has been counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A row of names, numbers and labels is well below 1 KB, so this stays within a
# few hundred MB.
MAX_BROADCAST_ROWS = 250_000


def sized(dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, weight: Column | None = None) -> DataFrame:
    """``dim`` with the join hint its measured size allows.

    Within the bound the table is broadcast. Beyond it the join is a sort-merge
    join, whose hot partitions adaptive execution splits. ``weight`` says how
    many rows' worth a row with an array holds. The count stops one row past the
    bound, so checking a large table stays cheap. An exploded table hides its
    true size from the optimizer's estimate, hence the count.
    """
    worth = F.lit(1) if weight is None else F.greatest(weight, F.lit(1))
    total = dim.limit(max_rows + 1).agg(F.sum(worth)).first()[0] or 0
    return hinted(dim, total, max_rows)


def hinted(dim: DataFrame, total: int, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """The same for a size that is known already."""
    return F.broadcast(dim) if total <= max_rows else dim.hint("merge")


#: Parts that each name's rows are dealt to where names are too many to broadcast.
SALTS = 32


def join_names(rows: DataFrame, names: DataFrame, keys: list[str], by: list[str], total: int | None = None,
               max_rows: int | None = None) -> DataFrame:
    """``rows`` with those of ``names`` (unique by ``keys``) that they match; the others go.

    Within the bound, names are broadcast and nothing moves. Beyond it every name is sent to
    ``SALTS`` parts and the rows of a name are dealt to them by a hash of ``by``, columns that tell its
    rows apart. One hot name so fills many tasks, and since the parts are no key of
    what follows, a later grouping by name combines rows before it shuffles them.
    """
    max_rows = MAX_BROADCAST_ROWS if max_rows is None else max_rows
    if total is None:
        total = names.limit(max_rows + 1).count()
    if total <= max_rows:
        return rows.join(F.broadcast(names), keys)
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int"))
    sent = names.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(sent.hint("merge"), [*keys, "_salt"]).drop("_salt")
