"""The queries of this folder that have SQL, against it in DuckDB."""

import pytest

from tickspark.llm.queries import ORACLES, QUERIES
from verification.compare import compare, connect


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    df, sql = QUERIES[name](spark, sf_dir), ORACLES[name]
    # The comparer has no name for 32-bit numbers; both sides are widened.
    for c, kind in df.dtypes:
        if kind == "int":
            df, sql = df.withColumn(c, df[c].cast("bigint")), f'SELECT * REPLACE (CAST("{c}" AS BIGINT) AS "{c}") FROM ({sql})'
    assert compare(df, connect(sf_dir), sql) is None


def test_queries_with_sql():
    assert {"op3_topk_search", "op4_chat_format", "op5_embedding_dedup"} <= set(ORACLES)
