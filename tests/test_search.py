"""Searches on planted optima."""

import math
import random

from given import SMALL
from millrace.operators.search import Between, best, parzen_search, propose
from millrace.plans import catalog

SPACE = {"x": Between(0, 10), "rate": Between(1e-4, 1.0, log=True), "depth": Between(2, 12, whole=True), "kind": ["a", "b", "c"]}


def score(p, budget=1.0):
    return -((p["x"] - 7) ** 2) / 10 - (math.log10(p["rate"]) + 2) ** 2 - abs(p["depth"] - 5) / 3 - (p["kind"] != "b") + 0.01 * budget


def test_beats_random_search():
    found, blind = [], []
    for seed in range(40):
        found.append(best(parzen_search(score, SPACE, n=40, seed=seed))[1])
        rnd = random.Random(1000 + seed)
        blind.append(max(score({k: v.draw(rnd) if isinstance(v, Between) else rnd.choice(v) for k, v in SPACE.items()}) for _ in range(40)))
    assert sum(found) / 40 > sum(blind) / 40 + 0.2
    assert sum(f > b for f, b in zip(found, blind, strict=True)) >= 26


def test_same_result_whatever_runs_first():
    runs = [parzen_search(score, SPACE, n=23, seed=4, parallel=p) for p in (1, 8)]
    assert runs[0] == runs[1] and len(runs[0]) == 23
    assert all(0 <= p["x"] <= 10 and 1e-4 <= p["rate"] <= 1 and isinstance(p["depth"], int) and p["kind"] in "abc" for _, p, _, _ in runs[0])


def test_brackets_give_the_greatest_budget_to_the_better_third():
    trials = parzen_search(score, SPACE, n=30, budgets=(0.1, 0.3, 1.0), seed=2)
    by = {b: [t for t in trials if t[2] == b] for b in (0.1, 0.3, 1.0)}
    assert len(by[0.1]) == 30 and len(by[0.3]) == 3 + 7 and len(by[1.0]) == 1 + 7
    assert {t[0] for t in by[1.0]} <= {t[0] for t in by[0.3]} and best(trials)[1] == max(t[3] for t in by[1.0])


def test_proposals_cover_the_space_without_trials():
    p = propose({"k": ["only"], "z": Between(3, 3)}, [({"k": "only", "z": 3}, 0.0)], random.Random(0))
    assert p == {"k": "only", "z": 3}


def test_registered_search(spark):
    rows = catalog.queries()["E8_parzen_search"](spark, SMALL).collect()
    assert len({r.trial for r in rows}) == 30 and max(r.auroc for r in rows) > 0.75
