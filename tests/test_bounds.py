"""Vectors with components on the bounds of the bases, which are floats: 0.08 itself is T."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from oracle import TABLES, connect, oracle_rows, rows_of

from curaspark.plans import registry

QUERIES = ["site_profile", "shared_sequences", "column_changes"]


@pytest.fixture(scope="module")
def on_bounds(tmp_path_factory):
    folder = tmp_path_factory.mktemp("bounds")
    for name in (n for n in TABLES if n != "embeddings"):
        (folder / f"{name}.parquet").symlink_to(f"/root/testdata/sf0.001/{name}.parquet")
    vectors = pq.read_table("/root/testdata/sf0.001/embeddings.parquet")
    rows = [[(-0.08, 0.08)[v % 2] if i % 7 == 2 and v % 4 == i % 4 else x for i, x in enumerate(row)] for v, row in enumerate(vectors["embedding"].to_pylist())]
    pq.write_table(vectors.set_column(1, vectors.schema.field(1), pa.array(rows, vectors.schema.field(1).type)), folder / "embeddings.parquet")
    return str(folder)


@pytest.mark.parametrize("name", QUERIES)
def test_bounds_are_floats(spark, on_bounds, name):
    df = registry.queries()[name](spark, on_bounds)
    columns = sorted(df.columns)
    assert rows_of(df, columns) == oracle_rows(connect(on_bounds), registry.oracle_sql()[name], columns)
