"""The kernel machine against the dense dual problem."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from given import SMALL
from millrace.operators.kernel import KernelMachine
from millrace.plans import catalog


def dense_dual(kernel, y, c, tol=1e-8):
    """Decision values of the support vector machine with penalty c, by pairs that violate the conditions most."""
    n = len(y)
    alpha, grad = np.zeros(n), -np.ones(n)
    q = kernel * y[:, None] * y[None]
    for _ in range(200_000):
        up = ((y > 0) & (alpha < c)) | ((y < 0) & (alpha > 0))
        down = ((y < 0) & (alpha < c)) | ((y > 0) & (alpha > 0))
        value = -y * grad
        i, j = np.flatnonzero(up)[value[up].argmax()], np.flatnonzero(down)[value[down].argmin()]
        if value[i] - value[j] < tol:
            break
        curve = max(kernel[i, i] + kernel[j, j] - 2 * kernel[i, j], 1e-12)
        t = (value[i] - value[j]) / curve
        t = min(t, c - alpha[i] if y[i] > 0 else alpha[i], alpha[j] if y[j] > 0 else c - alpha[j])
        for k, s in ((i, y[i] * t), (j, -y[j] * t)):
            alpha[k] += s
            grad += q[:, k] * s
    free = (alpha > 1e-9) & (alpha < c - 1e-9)
    f = kernel @ (alpha * y)
    return f + np.mean((y - f)[free])


@pytest.mark.parametrize("kernel", [{"gamma": 0.5}, {"degree": 2}])
def test_as_the_dense_dual(spark, kernel):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(120, 3))
    y = np.where((x**2).sum(1) + 0.4 * rng.normal(size=120) > 2.5, 1.0, -1.0)
    df = spark.createDataFrame([([float(v) for v in r], int(t > 0)) for r, t in zip(x, y, strict=True)] + [(None, 1), ([0.0, 0.0, 0.0], None)], "x array<double>, label int")
    machine = KernelMachine("x", landmarks=1000, reg=0.01, smooth=0.005, **kernel).fit(df.repartition(3))
    got = machine.features(x) @ machine.weights + machine.intercept
    want = dense_dual(machine._kernel(x, x), y, 1 / (0.01 * 120))
    assert np.abs(got - want).max() < 0.05 and (np.sign(got) == np.sign(want)).mean() > 0.97
    hinge = lambda f: np.maximum(0, 1 - y * f).mean()
    assert hinge(got) + 0.01 / 2 * (machine.weights**2).sum() <= machine.objective + 1e-9
    scored = machine.transform(df.where("x IS NOT NULL")).collect()
    assert len(scored) == 121 and scored[0].margin == pytest.approx(got[0])


def test_few_landmarks_come_near(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 2))
    y = (x[:, 0] * x[:, 1] > 0).astype(int)
    df = spark.createDataFrame([([float(v) for v in r], int(t)) for r, t in zip(x, y, strict=True)], "x array<double>, label int")
    full, few = (KernelMachine("x", gamma=1.0, landmarks=m, reg=0.0005).fit(df) for m in (400, 60))
    a, b = (m.features(x) @ m.weights + m.intercept for m in (full, few))
    assert ((a > 0) == (y > 0)).mean() > 0.93 and ((a > 0) == (b > 0)).mean() > 0.93
    assert full.objective <= few.objective + 1e-3


def test_registered_query(spark):
    out = catalog.queries()["M8_kernel_machine"](spark, SMALL)
    assert out.columns == ["vec_id", "prediction", "pd"]
    assert out.count() > 100 and out.where(~F.col("pd").between(0, 1)).count() == 0
