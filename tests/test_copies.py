"""Pictures that look equal are pairs of the result, too."""

from __future__ import annotations

from datetime import datetime

import pytest

from millrace.plans import core_queries


@pytest.mark.parametrize("name", ["similar_pictures", "similar_pictures_top"])
def test_copies_are_in_the_result(spark, tmp_path, name):
    ids = ["a", "b", "c"]
    rows = [(i, list(range(8)), [1.0] + [0.0] * 511, datetime(2025, 1, 1)) for i in ids]
    spark.createDataFrame(rows, "sample_id string, phashes array<bigint>, histogram array<float>, computed_at timestamp").write.parquet(str(tmp_path / "descriptors.parquet"))
    rows = core_queries.QUERIES[name](spark, str(tmp_path)).collect()
    assert len(rows) == 6 and {(r.query, r.other, r.distance) for r in rows} == {(a, b, 0) for a in ids for b in ids if a != b}
