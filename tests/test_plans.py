"""Plan shape checks: no pairwise joins, filters and pruning at the scan."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF001

PAIRWISE = ("CartesianProduct", "BroadcastNestedLoopJoin")
NAMES = ("quote_shortlist", "tag_topic_edges", "bridge_tags", "align_topics", "topic_parents",
         "assign_topics", "text_search", "windows_in_candidates", "upsert_articles", "articles_flat")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_pairwise_joins(spark, name):
    plan = _plan(E.queries()[name](spark, SF001))
    assert not any(p in plan for p in PAIRWISE), name


def test_scan_pushdown_and_pruning(spark):
    df = E.queries()["scan_nonblank"](spark, SF001)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert "PushedFilters: [IsNotNull(text)]" in scan
    cols = scan.split("FileScan parquet [", 1)[1].split("]", 1)[0]
    # only the columns the projection needs: lang and n_chars are pruned
    assert [c.split("#")[0] for c in cols.split(",")] == ["doc_id", "text", "source"]
