"""The driver contract: entry() runs on the smallest scale and has a stable schema."""

import re

import __spark_entry__ as E


def test_entry_schema_and_rows(spark):
    df = E.entry(spark)
    assert df.schema.simpleString() == "struct<pickup_zone:string,trips:bigint,revenue:double>"
    n = df.count()
    assert 0 < n <= 15


def test_every_query_has_sql_except_model_training():
    own = {q for q in E.queries() if not re.match(r"op\d+_|pipeline$", q)}  # the others are an optional subpackage's
    assert own - set(E.oracle_sql()) == {"ML11_model_comparison"}
    assert set(E.oracle_sql()) <= set(E.queries())
