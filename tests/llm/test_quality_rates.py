import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from attemptlog.llm import quality


def test_capped_kinds_keep_the_rate_of_all_labels(spark, monkeypatch):
    """Labels that the texts do not explain: every score is near the rate of good ones."""
    monkeypatch.setattr(quality, "LABELLED", 256)
    rng = random.Random(5)
    words = [f"word{i}" for i in range(300)]
    docs = [(i, " ".join(rng.choices(words, k=40)), "a", "en", 200) for i in range(1500)]
    labels = [(i, int(rng.random() < 0.92)) for i in range(1500)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string, n_chars long")
    told = spark.createDataFrame(labels, "doc_id long, quality int")
    out = quality.classify(df, "doc_id", told, "doc_id", "quality")
    score = out.agg(F.avg("score"), F.avg(F.col("kept").cast("int"))).first()
    assert score[0] == pytest.approx(0.92, abs=0.04)
    assert score[1] > 0.98


def test_calibration_counts_by_weight():
    y = np.array([True] * 75 + [False] * 25)
    weight = np.where(y, 2.0, 1.0)
    w, b = quality.calibrate(np.zeros((100, 1)), y, weight)
    assert 1 / (1 + np.exp(-b)) == pytest.approx(150 / 175, abs=0.02)
