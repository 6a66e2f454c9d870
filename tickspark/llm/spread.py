"""Joins of rows with one row per key, where one key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Parts that the rows of one key are dealt over.
PARTS = 64
PART = "_part_of_a_key"


def spread_join(rows: DataFrame, per_key: DataFrame, keys: list[str], row: str = "row", parts: int = PARTS) -> DataFrame:
    """``rows`` with the columns of ``per_key``, which has one row for each of their ``keys`` (not null).

    A key's rows are dealt over ``parts`` by the number in ``row``, so no task gets more than that share of them. What
    is copied is a row of ``per_key`` for each part in which the key occurs: never more than the rows.
    """
    dealt = rows.withColumn(PART, F.pmod(F.xxhash64(row), F.lit(parts)).cast("int"))
    wanted = dealt.select(*keys, PART).distinct()
    return dealt.join(wanted.join(per_key, keys), [*keys, PART]).drop(PART)


def numbered(index: int, task: int) -> int:
    """A number no other row has, from the row's place in its task. Write it to a table before use: another run of
    the same input may deal the rows differently."""
    return (task << 36) + index
