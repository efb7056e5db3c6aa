"""Registered model queries ask for the operators' full search."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from tallyline.plans import churn as M
from tallyline.plans import clustering as K
from tallyline.queries import scoring


class Asked(Exception):
    pass


def caught(monkeypatch, module, name, run):
    def stop(*args, **options):
        raise Asked(args, options)
    monkeypatch.setattr(module, name, stop)
    with pytest.raises(Asked) as e:
        run()
    return e.value.args


def test_models_come_from_the_full_search(monkeypatch):
    r = SimpleNamespace(train_features=None, mart_features=None, scratch=None, spark=None, lake=SimpleNamespace(root=""))
    monkeypatch.setattr(M, "split", lambda df: (df, df))
    monkeypatch.setattr(scoring, "is_complete", lambda *_: False)
    for run in (lambda: scoring.trained(r), lambda: scoring.training_run(r)):
        args, options = caught(monkeypatch, M, "train_boosted", run)
        assert len(args[1]) == 50 and all(set(c) == set(M.SEARCH_SPACE) for c in args[1])
        assert [*args[2:], *options.values()] in ([], [5])
    assert caught(monkeypatch, K, "run_clustering", lambda: scoring.clustered(r))[1].get("runs", 10) == 10


def test_training_run_keeps_the_gate(monkeypatch):
    r = SimpleNamespace(train_features=None, scratch=None, spark=None, lake=SimpleNamespace(root=""))
    monkeypatch.setattr(scoring, "is_complete", lambda *_: False)
    args, options = caught(monkeypatch, M, "run_training", lambda: scoring.training_run(r))
    assert options.get("enforce", True)
