"""Joining many rows to one row per key, where a few keys may hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def lookup(facts: DataFrame, per_key: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join ``facts`` to ``per_key``, an aggregate with one row per (integer) ``key``.

    Adaptive execution cuts a hot partition into as many pieces as it needs, but
    only where both sides of the join come straight from an exchange. An
    aggregate is already partitioned by its key and would be joined in place,
    leaving all rows of a popular key to one task. Recomputing the key (as itself
    or-ed with 0, which the optimizer does not see through) gives that side an
    exchange of its own; one row per key is little to move.
    """
    others = [c for c in per_key.columns if c != key]
    return facts.join(per_key.select(F.col(key).bitwiseOR(0).alias(key), *others), key, how)
