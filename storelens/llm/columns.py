"""Columns of a caller's table that have the names of an operator's helper columns."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from itertools import count

from pyspark.sql import DataFrame


def set_aside(*helpers: str) -> Callable:
    """For a function of a table that makes helper columns of these names: the table's own columns of such names keep their content.

    They bear names that are not in use while the function runs. Names differ in more than upper and lower case, as in Spark.
    """

    def around(run: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @wraps(run)
        def kept(docs: DataFrame, *args, **options) -> DataFrame:
            taken = {c.lower() for c in (*docs.columns, *helpers)}
            renamed = {}
            for name in docs.columns:
                if name.lower() in helpers:
                    renamed[name] = next(n for n in (f"{name}{k}" for k in count()) if n.lower() not in taken)
                    taken.add(renamed[name].lower())
            if not renamed:
                return run(docs, *args, **options)
            out = run(docs.withColumnsRenamed(renamed), *args, **options)
            return out.withColumnsRenamed({now: name for name, now in renamed.items()})

        return kept

    return around
