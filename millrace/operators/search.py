"""Searches that learn from finished trials: Parzen-estimator proposals, and brackets that stop weak trials early."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass


@dataclass(frozen=True)
class Between:
    """Numbers from ``low`` to ``high``, evenly in their logarithm if ``log``; whole ones if ``whole``."""

    low: float
    high: float
    log: bool = False
    whole: bool = False

    def to(self, x: float) -> float:
        return math.log(x) if self.log else float(x)

    def back(self, u: float):
        x = min(self.high, max(self.low, math.exp(u) if self.log else u))
        return int(round(x)) if self.whole else x

    def draw(self, rnd: random.Random):
        return self.back(rnd.uniform(self.to(self.low), self.to(self.high)))


Space = Mapping[str, Between | Sequence]


def _density(values: list[float], at: float, low: float, high: float) -> float:
    """Parzen estimate with one wide component, so that nothing is ever impossible."""
    span = high - low or 1.0
    wide = 1 / span
    if not values:
        return wide
    width = max(span / 20, span / (1 + len(values)))
    bell = sum(math.exp(-0.5 * ((at - v) / width) ** 2) for v in values) / (width * math.sqrt(2 * math.pi))
    return (bell + wide) / (len(values) + 1)


def propose(space: Space, done: Sequence[tuple[dict, float]], rnd: random.Random, share: float = 0.15, candidates: int = 24) -> dict:
    """The candidate that is most likelier among the best ``share`` of the trials than among the rest, setting by setting."""
    ranked = sorted(done, key=lambda t: -t[1])
    cut = max(1, math.ceil(share * len(ranked)))
    good, rest = [p for p, _ in ranked[:cut]], [p for p, _ in ranked[cut:]]
    out = {}
    for name, values in space.items():
        if isinstance(values, Between):
            low, high = values.to(values.low), values.to(values.high)
            a, b = ([values.to(p[name]) for p in side] for side in (good, rest))
            width = (high - low) / 20
            tries = [rnd.gauss(rnd.choice(a), width) if rnd.random() < len(a) / (len(a) + 1) else rnd.uniform(low, high) for _ in range(candidates)]
            tries = [min(high, max(low, u)) for u in tries]
            out[name] = values.back(max(tries, key=lambda u: _density(a, u, low, high) / _density(b, u, low, high)))  # noqa: B023
        else:
            odds = {v: (sum(p[name] == v for p in good) + 1) / (sum(p[name] == v for p in rest) + 1) for v in values}
            weights = [sum(p[name] == v for p in good) + 1 for v in values]
            out[name] = max(rnd.choices(list(values), weights, k=candidates), key=lambda v: odds[v])  # noqa: B023
    return out


def parzen_search(objective: Callable[[dict, float], float], space: Space, n: int = 30, first: int = 10, batch: int = 3, budgets: Sequence[float] = (1.0,), seed: int = 31, parallel: int = 4) -> list[tuple[int, dict, float, float]]:
    """[(trial, settings, budget, score)] of ``n`` trials; higher scores are better.

    The ``first`` trials are drawn at random, then each batch is proposed from the finished trials and run concurrently
    (objectives usually start Spark jobs). With several ascending ``budgets`` a batch is a bracket: every trial gets the
    least budget, and the better third of it the next one. Trials of the same budget are compared, those of the greatest
    budget that has enough of them. The result does not depend on which job ends first.
    """
    rnd = random.Random(seed)
    out: list[tuple[int, dict, float, float]] = []
    trial = 0
    with ThreadPoolExecutor(parallel) as pool:
        while trial < n:
            size = min(first if trial == 0 else batch, n - trial)
            known = next((k for b in reversed(budgets) if len(k := [(p, s) for _, p, at, s in out if at == b]) >= 4), [(p, s) for _, p, _, s in out])
            fresh: list[tuple[int, dict]] = []
            for _ in range(size):
                for _ in range(50):  # a setting that was tried before teaches nothing
                    p = propose(space, known, rnd) if trial else {k: v.draw(rnd) if isinstance(v, Between) else rnd.choice(list(v)) for k, v in space.items()}
                    if all(p != q for _, q, *_ in out) and all(p != q for _, q in fresh):
                        break
                fresh.append((trial, p))
                trial += 1
            for b in budgets:
                scores = list(pool.map(lambda t: objective(t[1], b), fresh))  # noqa: B023
                out += [(i, p, b, s) for (i, p), s in zip(fresh, scores, strict=True)]
                ranked = sorted(zip(fresh, scores, strict=True), key=lambda t: (-t[1], t[0][0]))
                fresh = [t for t, _ in ranked[: max(1, len(ranked) // 3)]]
    return out


def best(trials: Sequence[tuple[int, dict, float, float]]) -> tuple[dict, float]:
    """The best settings among the trials of the greatest budget."""
    most = max(b for _, _, b, _ in trials)
    _, p, _, s = max((t for t in trials if t[2] == most), key=lambda t: (t[3], -t[0]))
    return p, s
