"""Joins against catalogues and lookups.

No join here carries a broadcast hint. Spark broadcasts a side when its measured size is below
`spark.sql.autoBroadcastJoinThreshold` (file statistics when planning, shuffle statistics under
AQE), and otherwise shuffles; a key that holds a large share of the rows is then split by AQE's
skew join. The functions make the right side as narrow and unique as the semantics allow, so
that it is measured small when it is small.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def renamed(df: DataFrame, prefix: str) -> DataFrame:
    """Every column under a prefix, so that wide star projections have no duplicate names."""
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in df.columns])


def join_on(left: DataFrame, right: DataFrame, keys: dict[str, str], how: str) -> DataFrame:
    """Equi-join of `left[k] = right[v]`; the right keys are dropped."""
    marked = right.select(
        *[F.col(c).alias(f"__{c}") if c in keys.values() else F.col(c) for c in right.columns]
    )
    condition = reduce(lambda a, b: a & b, [left[k] == marked[f"__{v}"] for k, v in keys.items()])
    joined = left.join(marked, condition, how)
    return joined if how.endswith(("semi", "anti")) else joined.drop(*[f"__{v}" for v in keys.values()])


def name_of(df: DataFrame, catalogue: DataFrame, keys: dict[str, str], name: str, alias: str) -> DataFrame:
    """Add a looked-up name; NULL when the id is unknown."""
    narrow = catalogue.select(*keys.values(), F.col(name).alias(alias))
    return join_on(df, narrow, keys, "left")


def in_order(df: DataFrame, ordered: bool, *keys: Column | str) -> DataFrame:
    """A report's row order; leave it off when the result feeds another job."""
    return df.orderBy(*keys) if ordered else df
