"""Lookups and sums of the delivery and meal reports as they grow with the number of sites."""

import math
import re

import pytest

from refectory import registry
from refectory.plans import delivery_reports as R
from refectory.plans.deliveries import domain

from .conftest import DATA

REPORTS = ["stats_fcj59_detail", "stat_effect_cred_1", "stats_liv", "stats_liv59", "stats_liv_annee", "stats_liv_egalim", "stats_liv_egalim_jour", "stats_liv_mois", "stats_dashboard", "dashboard_kpis"]


@pytest.mark.parametrize("name", REPORTS)
def test_what_sites_keep_is_not_sent_to_the_driver(spark, name):
    """Spark takes exploded rows for as few as they come from, and would send them all."""
    plan = registry.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [__route" in plan
    assert not re.search(r"Broadcast\w*Join \[__route", plan)


def test_a_large_fact_goes_into_more_tasks(spark, monkeypatch):
    t = domain(spark, DATA)
    assert R.tasks(t["effect"]) == 4
    monkeypatch.setattr(R, "ROWS_A_TASK", 500)
    n = math.ceil(t["effect"].count() / 500)
    assert R.tasks(t["effect"]) == n


@pytest.mark.parametrize("name", REPORTS)
def test_rows_of_a_lookup_are_dealt_out_before_they_are_sorted(spark, name):
    """A sorted sum right above the rows that are made of the sites would hold them all in the one task that made them."""
    plan = registry.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString().splitlines()
    at = [i for i, x in enumerate(plan) if re.search(r"SortAggregate\(.*partial_first\((lib|type|egalim)", x)]
    assert at or name == "stats_fcj59_detail"
    for i in at:
        below = [re.sub(r"^[\s:+-]*", "", x) for x in plan[i + 1 :]][:3]
        assert any(x.startswith("Exchange hashpartitioning(login_site") for x in below), below


def test_labels_of_a_group_are_looked_up_in_parts(spark, monkeypatch):
    own = lambda: sorted(tuple(r) for r in registry.queries()["stats_dashboard"](spark, DATA).collect())
    want = own()
    monkeypatch.setattr(R, "ROWS_A_TASK", 200)
    assert math.ceil(R.tasks(domain(spark, DATA)["mvtart"]) / 24) > 1
    df = registry.queries()["stats_dashboard"](spark, DATA)
    assert re.search(r"SortMergeJoin \[__route#\d+, label1#\d+, __part", df._jdf.queryExecution().executedPlan().toString())
    got = own()
    assert [r[:-2] for r in got] == [r[:-2] for r in want]
    assert [x for r in got for x in r[-2:]] == pytest.approx([x for r in want for x in r[-2:]])


@pytest.mark.parametrize("name", ["stats_liv_annee", "stats_liv_egalim", "stats_liv_egalim_jour", "stat_effect_cred_1"])
def test_what_a_group_keeps_few_of_is_looked_up_in_parts(spark, monkeypatch, name):
    """A group has the same few families and suppliers however many movements there are: one key's rows would be one task's."""
    key = lambda r: [(x is not None, str(x)) for x in r if not isinstance(x, float)]
    own = lambda: sorted(registry.queries()[name](spark, DATA).collect(), key=key)
    want = own()
    monkeypatch.setattr(R, "ROWS_A_TASK", 200)
    plan = registry.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    for x in ("codcateg", "annee", "codss1", "codss2") if name == "stat_effect_cred_1" else ("f_ocleunik", "famille_article"):
        assert re.search(rf"SortMergeJoin \[__route#\d+, {x}#\d+, __part", plan), x
    got = own()
    assert [key(r) for r in got] == [key(r) for r in want]
    assert [x for r in got for x in r if isinstance(x, float)] == pytest.approx([x for r in want for x in r if isinstance(x, float)], abs=0.011)  # shares are rounded


@pytest.mark.parametrize("name", ["stats_liv_annee", "stats_liv_egalim", "stats_liv_egalim_jour"])
def test_articles_of_sites_are_told_apart_in_tasks_that_grow(spark, monkeypatch, name):
    """A sum over what one task reads of the lines, or over a fixed number of tasks, would hold more for more lines."""
    monkeypatch.setattr(R, "ROWS_A_TASK", 500)
    n = R.tasks(domain(spark, DATA)["mvtart"])
    plan = registry.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert re.search(rf"Exchange hashpartitioning\(p_partkey#\d+L?, {n}\), REPARTITION_BY_NUM", plan)
    assert not re.search(r"Broadcast\w*Join \[p_partkey", plan)
    lines = plan.splitlines()
    at = [i for i, x in enumerate(lines) if re.search(r"HashAggregate\(keys=\[login_site#\d+, p_partkey#\d+L?\]", x)]
    assert at and not any("Exchange" in lines[i + 1] and "REPARTITION_BY_NUM" not in lines[i + 1] for i in at)
