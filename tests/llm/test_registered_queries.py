"""Every registered corpus query on the small tables: rows, its SQL where there is one, and its plan."""

import duckdb
import pytest

import corpus_pipeline
from obslake.llm.oracle import ORACLE
from obslake.llm.queries import QUERIES
from tools.check_oracle import TABLES, canonical, kind

ALL = QUERIES | {"pipeline": corpus_pipeline.run}


@pytest.mark.parametrize("name", sorted(ALL))
def test_query_runs_and_matches_its_sql(spark, sf, plan, name):
    df = ALL[name](spark, sf)
    text = plan(df)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text and "BatchEvalPython" not in text
    if name == "op3_quality_rules":
        assert "Python" not in text and "InArrow" not in text and "InPandas" not in text
    left = df.toPandas()
    assert len(left) > 0
    if name in ORACLE:
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
        rel = con.sql(ORACLE[name])
        assert {f.name: kind(f.dataType.simpleString()) for f in df.schema.fields} == {c: kind(t) for c, t in zip(rel.columns, rel.types)}
        assert canonical(left) == canonical(rel.arrow().read_all().to_pandas())
