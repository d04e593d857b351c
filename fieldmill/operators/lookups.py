"""Left joins."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmill.functions.text import quoted


def lookup_roles(
    df: DataFrame, dimension: DataFrame, key: str, value: str, roles: Mapping[str, str]
) -> DataFrame:
    """Look one dimension up once per role.

    ``roles`` maps a column of ``df`` to the name of the looked-up value, for instance
    ``{"origin": "origcity", "dest": "destcity"}``. Rows without a match keep a null; a repeated
    key in the dimension repeats the row, as in any left join.

    There is no join hint: Spark broadcasts the two dimension columns when their size is below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise. In that case adaptive
    execution may split a key that holds a large share of ``df``, since ``df`` is the outer side.
    """
    for role, output in roles.items():
        lookup_key = f"__{role}_{key}"
        looked_up = dimension.select(
            F.col(quoted(key)).alias(lookup_key), F.col(quoted(value)).alias(output)
        )
        on = F.col(quoted(role)) == F.col(quoted(lookup_key))
        df = df.join(looked_up, on, "left").drop(lookup_key)
    return df


def left_join_many(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """``left LEFT JOIN right`` where one key of ``right`` may hold much of the data.

    Spark splits a heavy key of a left join only on the left side, of an inner join on either. So this is an
    inner join and, with nulls for the columns of ``right``, the rows of ``left`` whose key ``right`` doesn't
    hold; its distinct keys are aggregated before their shuffle, which takes the heat out of them. Both
    inputs are read twice and must be deterministic.
    """
    key, other = F.col(quoted(left_key)), F.col(quoted(right_key))
    matched = left.join(right, key == other)
    keys = right.select(other.alias("__held")).distinct()
    nulls = [F.lit(None).cast(field.dataType).alias(field.name) for field in right.schema.fields]
    unmatched = left.join(keys, key == F.col("__held"), "left_anti").select("*", *nulls)
    return matched.union(unmatched)
