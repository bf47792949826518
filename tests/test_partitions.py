
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

KEYS = ["duplicate_titles", "route_duplicates", "fetch_outcome", "crawl_progress",
        "keyword_score", "vector_score", "child_chunks", "upsert_plan"]


@pytest.mark.parametrize("key", KEYS)
def test_same_answer_at_2_and_200_partitions(spark, key):
    q = entry.queries()[key]
    results = []
    for n in ("2", "200"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            results.append(sorted(map(repr, q(spark, SF_SMALL).collect())))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1]
