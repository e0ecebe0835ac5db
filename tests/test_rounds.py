"""Work per round of the iterative fits."""

from __future__ import annotations

import random

from occuflow import session
from occuflow.operators import models


def test_kmeans_rounds_write_two_tables(spark, monkeypatch):
    """A round writes the assigned points and the new centres, nothing else."""
    rng = random.Random(1)
    rows = [(s, f"p{i}", rng.uniform(-50, 50), rng.uniform(-50, 50)) for s in "ab" for i in range(60)]
    frame = spark.createDataFrame(rows, "Species string, H3 string, LAT double, LON double")
    written = []
    write = session._write_stage
    monkeypatch.setattr(session, "_write_stage", lambda *a, **o: written.append(1) or write(*a, **o))
    out = models.kmeans_minus_minus(frame, 4, 3, max_iter=3).collect()
    # points, group sizes, first centres and final assignment, and two a round
    assert len(written) <= 4 + 2 * 3
    assert len(out) == len(rows) and sum(r["is_outlier"] for r in out) == 6
    for s in "ab":
        far = sorted((r["OutlierScore"] for r in out if r["Species"] == s), reverse=True)
        assert min(r["OutlierScore"] for r in out if r["Species"] == s and r["is_outlier"]) == far[2]
