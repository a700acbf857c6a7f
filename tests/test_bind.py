"""Views give the same values in Spark and in DuckDB."""

import os

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import rows

from railtable.plans.bind import VIEWS, duck, view


@pytest.fixture
def folder(tmp_path):
    """Embeddings whose entries, times 2,000, are halves as floats and just beside halves as doubles."""
    v = (np.arange(-400, 400) + 0.5).astype("float32") / np.float32(2000)
    v = v[(v * np.float32(2000)).astype("float64") != v.astype("float64") * 2000]
    assert len(v) > 100
    table = pa.table({"vec_id": pa.array(range(len(v)), pa.int64()), "embedding": pa.array([[x, -x] for x in v], pa.list_(pa.float32())), "label": pa.array([k % 3 for k in range(len(v))], pa.int32())})
    pq.write_table(table, tmp_path / "embeddings.parquet")
    return str(tmp_path)


def test_positions_round_as_floats(spark, folder):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{os.path.join(folder, 'embeddings.parquet')}')")
    want = con.execute(duck("SELECT * FROM v_positions")).fetchall()
    assert rows(view(spark, folder, "SELECT * FROM v_positions"), "station_id", "line_id", "x", "y") == sorted(want)


def test_sql_of_positions_is_plain():
    assert "round((embedding)[1] * 2000)" in duck("SELECT * FROM v_positions") and "@single" in VIEWS["v_positions"]
