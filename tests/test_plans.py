import inspect
from unittest.mock import MagicMock

import pytest

from kinspan.operators import models
from kinspan.plans import demo, linkage, oracles, queries
from kinspan.schema import ThresholdConfig

SF = "/root/testdata/sf0.001"


def test_every_oracle_has_a_query():
    assert set(oracles.oracle_sql()) <= set(queries.queries())


def test_pipeline_keeps_its_rules(spark):
    out = linkage.run_pipeline(*demo.sources(spark, SF), models.rule_score(), ThresholdConfig(0.6, 0.6))
    n = demo.sources(spark, SF)[0].count()
    assert out["matching_results"].count() == out["candidate_pairs"].count() == n
    lists = out["candidate_pairs"].withColumnRenamed("candidate_entity_ids", "c").join(out["matching_results"], "source1_entity_id").collect()
    assert all(set(filter(None, r.matched_entity_ids.split(","))) <= set(r.c.split(",")) and len(r.c.split(",")) <= 10 for r in lists)


def test_training_reports(spark):
    s1, s2, s3 = demo.sources(spark, SF)
    got = linkage.train(s1, s2, s3, demo.truth_table(spark, SF), rounds=2)
    assert got["grid"].count() == 19 and got["metrics"].first().n_entities == 10
    assert {r.model for r in got["baselines"].collect()} == set(models.BASELINES)
    assert got["blocking_quality"].first().candidate_recall > 0.5


def test_entry_registers_all():
    import __spark_entry__ as entry

    known = entry.queries()
    assert set(queries.queries()) <= set(known) and set(entry.oracle_sql()) <= set(known)


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize(("name", "fit", "least"), [("gbt_scores", "fit_gbt", 400), ("logreg_scores", "fit_logistic", 1000)])
def test_training_queries_run_all_rounds_of_the_operators(monkeypatch, name, fit, least):
    usual, seen = inspect.signature(getattr(models, fit)), []
    monkeypatch.setattr(queries, "_labelled", lambda *_: MagicMock())
    monkeypatch.setattr(models, fit, lambda *a, **b: seen.append(usual.bind(*a, **b)))
    monkeypatch.setattr(models, "score_pairs", lambda *_: None)
    queries.queries()[name](None, "")
    seen[0].apply_defaults()
    assert seen[0].arguments["rounds"] == least
