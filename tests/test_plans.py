"""Plan-shape checks: what must (not) be shuffled, partial top-k, broadcasts."""

import os
import re


from conftest import ROOT, SF_SMALL
from sitecorpus.operators.duplicates import latest_pages, route_duplicates, with_title_key
from sitecorpus.operators.upsert import assign_metadata
from sitecorpus.plans.catalog import table
from sitecorpus.plans.crawl import page_records


def _formatted(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def _keyed_exchange_inputs(plan):
    """Inputs of hash-partitioned shuffles (the round-robin spread of a single-partition
    scan is excluded: on large inputs it is not planned at all)."""
    found = re.findall(r"\(\d+\) Exchange[^\n]*\nInput \[\d+\]: \[([^\]]*)\]\n"
                       r"Arguments: (\w+)", plan)
    return [cols for cols, kind in found if kind == "hashpartitioning"]


def test_routing_has_no_window_and_no_html_shuffle(spark):
    recs = latest_pages(page_records(table(spark, SF_SMALL, "pages")))
    routed = route_duplicates(with_title_key(recs, title_col="title", stem_col="filename"))
    plan = _formatted(routed)
    assert "Window" not in plan
    inputs = _keyed_exchange_inputs(plan)
    assert inputs, plan[:2000]
    assert all("html" not in cols for cols in inputs)


def test_attempt_bodies_move_for_deciders_only(spark):
    from sitecorpus.operators.responses import resolve_attempts
    from sitecorpus.plans.frontier import ATTEMPT_ORDER, event_attempts
    attempts = event_attempts(table(spark, SF_SMALL, "events"))
    narrow = _formatted(resolve_attempts(attempts, 2, with_body=False, order=ATTEMPT_ORDER))
    assert all("body" not in cols for cols in _keyed_exchange_inputs(narrow))
    whole = _keyed_exchange_inputs(_formatted(resolve_attempts(attempts, 2, order=ATTEMPT_ORDER)))
    assert sum("body" in cols for cols in whole) <= 1  # the join with the deciding rows


def test_no_row_count_switches():
    """No join is chosen by counting rows, and nothing is broadcast by hand outside llm."""
    for folder, _, names in os.walk(os.path.join(ROOT, "sitecorpus")):
        for name in names:
            if name.endswith(".py") and "llm" not in folder:
                src = open(os.path.join(folder, name), encoding="utf-8").read()
                assert "broadcast(" not in src and "max_rows" not in src, name


def test_operator_modules_do_not_collect():
    base = os.path.join(ROOT, "sitecorpus", "operators")
    for name in os.listdir(base):
        if name.endswith(".py"):
            src = open(os.path.join(base, name), encoding="utf-8").read()
            assert ".collect()" not in src and "toPandas(" not in src, name


def test_attempt_numbering_is_partial_top_k(spark):
    from sitecorpus.operators.responses import resolve_attempts
    from sitecorpus.plans.frontier import ATTEMPT_ORDER, event_attempts
    out = resolve_attempts(event_attempts(table(spark, SF_SMALL, "events")), 2,
                           order=ATTEMPT_ORDER)
    assert "WindowGroupLimit" in _formatted(out)
