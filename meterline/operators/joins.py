"""Dimension joins.

No join here forces a broadcast: Catalyst broadcasts a side whose files are
below its byte threshold, and adaptive execution one whose measured size is,
so a small dimension never shuffles the fact and a large one never has to fit
in memory.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
           columns: Mapping[str, str], how: str = "left") -> DataFrame:
    """Attach dimension columns to a fact (J1 left / J3 inner).

    ``columns`` maps dimension column -> output name. The dimension key must be
    unique (checked by ``checks.unique``) so a left join keeps the fact's rows.
    """
    d = dim.select(F.col(dim_key).alias("__dim_key"),
                   *[F.col(src).alias(dst) for src, dst in columns.items()])
    j = fact.join(d, F.col(fact_key) == F.col("__dim_key"), how)
    return j.drop("__dim_key")


def enrich(fact: DataFrame, dim: DataFrame, dim_key: str,
           roles: Mapping[str, str], columns: Mapping[str, str]) -> DataFrame:
    """Role-playing dimension (J2): join the same dimension once per role.

    ``roles`` maps role prefix -> fact key column, e.g.
    ``{"pickup": "pickup_location_id", "dropoff": "dropoff_location_id"}``;
    ``columns`` maps dimension column -> suffix, e.g. ``{"borough": "borough"}``
    giving ``pickup_borough``. Both are left joins.
    """
    out = fact
    for role, key in roles.items():
        d = dim.select(F.col(dim_key).alias(f"__{role}_key"),
                         *[F.col(c).alias(f"{role}_{suf}") for c, suf in columns.items()])
        out = out.join(d, F.col(key) == F.col(f"__{role}_key"), "left").drop(f"__{role}_key")
    return out


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent row.

    A parent with a small key set is broadcast by Catalyst or AQE, so the child
    (the fact) is not shuffled; with a large one AQE splits skewed partitions.
    """
    keys = parent.select(F.col(pk).alias("__pk")).distinct()
    return (child.filter(F.col(fk).isNotNull())
                 .join(keys, F.col(fk) == F.col("__pk"), "left_anti"))


def touched(target: DataFrame, batch: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Target rows in the partitions the batch touches (J6, left semi join).

    The batch's distinct partition values are few (one per month), so AQE
    broadcasts them and the target is not shuffled.
    """
    parts = batch.select(*partition_cols).distinct()
    return target.join(parts, list(partition_cols), "left_semi")
