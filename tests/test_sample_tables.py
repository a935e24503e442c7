"""The two statements of the sample rules (DataFrame and SQL) give the same tables."""

import pytest
from pyspark.sql.types import StructType

from tallyloom.coverage.views import VIEWS, with_views
from tallyloom.sources.sample import sample_tables
from tallyloom.sources.schemas import SCHEMAS
from tests.compare import same_rows


@pytest.mark.parametrize("name", sorted(SCHEMAS))
def test_table(spark, duck, sf_dir, name):
    df = sample_tables(spark, sf_dir)[name]
    declared = StructType.fromDDL(SCHEMAS[name])
    assert [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in declared.fields]
    assert name in VIEWS
    same_rows(df, duck, with_views(f"SELECT * FROM {name}"))
