"""Logistic calibration of a few features, on arrays or on all rows of a table."""

from __future__ import annotations

from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Logistic:
    """Ridge-penalised logistic regression by Newton's method.

    With rows of one class only, or none, the score is the smoothed share of
    ones (one half without rows).
    """

    def __init__(self, features: np.ndarray, labels: np.ndarray, ridge: float = 1.0, rounds: int = 30):
        labels = np.asarray(labels, float)
        self.constant = None
        if len(labels) == 0 or labels.min() == labels.max():
            self.constant = float((labels.sum() + 0.5) / (len(labels) + 1))
            return
        self.mean, self.scale = features.mean(axis=0), features.std(axis=0) + 1e-9
        x, penalty = self._design(features), np.full(features.shape[1] + 1, ridge)
        penalty[0] = 1e-6
        self.weights = np.zeros(x.shape[1])
        for _ in range(rounds):
            p = self._squash(x @ self.weights)
            slope = x.T @ (labels - p) - penalty * self.weights
            curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
            step = np.linalg.solve(curve, slope)
            self.weights += step * min(1.0, 4.0 / (np.abs(step).max() + 1e-12))
            if np.abs(step).max() < 1e-8:
                break

    @classmethod
    def of_table(
        cls, rows: DataFrame, features: list[Column], label: Column, ridge: float = 1.0, rounds: int = 30
    ) -> Logistic:
        """The same from every row of a table: Spark adds up the steps, one small row a round.

        The table is read once a round, so it should be a stored one.
        """
        model, names = cls(np.empty((0, len(features))), np.empty(0)), [f"_x{n}" for n in range(len(features))]
        given = rows.select(*[f.cast("double").alias(n) for f, n in zip(features, names)], label.cast("double").alias("_y"))
        moments = [m for n in names for m in (F.avg(n), F.stddev_pop(n))]
        count, ones, *found = given.agg(F.count("_y"), F.coalesce(F.sum("_y"), F.lit(0.0)), *moments).first()
        if ones in (0, count):
            model.constant = float((ones + 0.5) / (count + 1))
            return model
        model.constant, model.mean, model.scale = None, np.array(found[::2]), np.array(found[1::2]) + 1e-9
        scaled = [(F.col(n) - float(m)) / float(s) for n, m, s in zip(names, model.mean, model.scale)]
        design = given.select(F.lit(1.0).alias("_one"), *[c.alias(n) for c, n in zip(scaled, names)], "_y")
        size = len(names) + 1
        pairs = list(combinations_with_replacement(range(size), 2))
        penalty = np.full(size, ridge)
        penalty[0] = 1e-6
        model.weights = np.zeros(size)
        for _ in range(rounds):
            x = [F.col(c) for c in ("_one", *names)]
            z = sum((w * c for w, c in zip(map(float, model.weights), x)), F.lit(0.0))
            squashed = 1 / (1 + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), z))))
            judged = design.withColumn("_p", squashed).withColumn("_v", F.col("_p") * (1 - F.col("_p")))
            slopes = [F.sum((F.col("_y") - F.col("_p")) * c) for c in x]
            sums = judged.agg(*slopes, *[F.sum(F.col("_v") * x[i] * x[j]) for i, j in pairs]).first()
            curve = np.diag(penalty)
            for (i, j), value in zip(pairs, sums[size:]):
                curve[i, j] += value
                curve[j, i] += value if i != j else 0
            step = np.linalg.solve(curve, np.array(sums[:size]) - penalty * model.weights)
            model.weights += step * min(1.0, 4.0 / (np.abs(step).max() + 1e-12))
            if np.abs(step).max() < 1e-8:
                break
        return model

    def _design(self, features: np.ndarray) -> np.ndarray:
        return np.column_stack([np.ones(len(features)), (features - self.mean) / self.scale])

    @staticmethod
    def _squash(z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def __call__(self, features: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(features), self.constant)
        return self._squash(self._design(np.asarray(features, float)) @ self.weights)
