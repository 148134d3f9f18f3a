from __future__ import annotations

import pytest
from pyspark.sql import DataFrame, SparkSession


@pytest.fixture()
def docs_of(spark: SparkSession):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), with a column whose name clashes with nothing
    but the operators' own."""

    def build(rows: list[tuple], extra: bool = True) -> DataFrame:
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s0") for r in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string")
        return df.selectExpr("*", "1 as kept", "'x' as fp", "2 as size", "3 as t", "array(1) as hashes") if extra else df

    return build
