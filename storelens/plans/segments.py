"""Segment rules over behaviour tables and the columns an activation sends."""

from __future__ import annotations

import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from storelens.operators.ranking import latest_by

COMPARE = {
    "Less": operator.lt,
    "LessEqual": operator.le,
    "Equal": operator.eq,
    "NotEqual": operator.ne,
    "GreaterEqual": operator.ge,
    "Greater": operator.gt,
}


def segment_count_rule(
    customers: DataFrame,
    behaviour: DataFrame,
    key: str,
    where: Column,
    compare: str,
    n: int,
    exclude: bool = False,
) -> DataFrame:
    """Customers whose number of matching behaviour rows compares to ``n``.

    Customers without any row count as 0, so "fewer than 1" finds them.
    """
    rows = behaviour.filter(where).filter(F.col(key).isNotNull())
    if compare == "Less" and n == 1:
        how = "left_semi" if exclude else "left_anti"
        return customers.join(rows.select(key), key, how)
    counts = rows.groupBy(key).agg(F.count("*").alias("_n"))
    hit = COMPARE[compare](F.coalesce(F.col("_n"), F.lit(0)), F.lit(n))
    return customers.join(counts, key, "left").filter(~hit if exclude else hit).drop("_n")


def activation_projection(
    df: DataFrame, columns: Sequence[dict], all_columns: bool = False
) -> DataFrame:
    """Columns of an activation: renamed columns and texts with ``$1``, ``$2``, ….

    A spec is ``{"column": name, "source": {"column": c}}`` or ``{"column": name,
    "source": {"string": "$1-$2", "parameters": [{"type": "String" | "Column", …}]}}``.
    With ``all_columns`` every other column is passed on as it is.
    """
    made: dict[str, Column] = {}
    for spec in columns:
        source = spec["source"]
        if "column" in source:
            made[spec["column"]] = F.col(source["column"])
            continue
        text = F.lit(source["string"])
        parameters = source.get("parameters", [])
        # the longest number first, so that $1 does not eat the start of $10
        for i in range(len(parameters), 0, -1):
            p = parameters[i - 1]
            value = (
                F.lit(p["string"])
                if p["type"] == "String"
                else F.coalesce(F.col(p["column"]).cast("string"), F.lit(""))
            )
            text = F.replace(text, F.lit(f"${i}"), value)
        made[spec["column"]] = text
    rest = [c for c in df.columns if c not in made] if all_columns else []
    return df.select(*rest, *[c.alias(name) for name, c in made.items()])


def latest_version_by_name(df: DataFrame, name: str = "name", version: str = "id") -> DataFrame:
    """The row with the largest numeric id per name."""
    number = F.coalesce(F.col(version).try_cast("bigint"), F.lit(0))
    return latest_by(df, [name], [number.desc(), F.desc(version)])
