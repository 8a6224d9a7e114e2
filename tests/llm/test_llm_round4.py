"""Tests of the fourth round: lengths without a switch, memory of the collocation passes."""

from __future__ import annotations

import corpus_pipeline
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from eventlink.llm import collocations, packing


def test_packing_is_exact_at_every_size(spark, monkeypatch):
    """However many lengths there are, the buckets end where the exact histogram wants them."""
    monkeypatch.setattr(packing, "MOST_LINES", 20)
    monkeypatch.setattr(packing, "EXACT", 4)
    monkeypatch.setattr(packing, "FINE", 1)
    rng = np.random.default_rng(8)
    n = rng.integers(1, 400, 300).tolist()
    rows = [(i, "", k) for i, k in enumerate(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long")
    lengths, counts = np.unique(n, return_counts=True)
    ends = packing.best_ends(lengths, counts, 5)
    out = packing.pack(df, length=F.col("n"), buckets=5).collect()
    assert {r.padded for r in out} == set(ends)
    assert all(r.padded == min(e for e in ends if e >= r.n_tokens) for r in out)


def test_every_length(spark):
    df = spark.createDataFrame([(7,), (1,), (7,), (300,)], "n long")
    lengths, counts = packing.every_length(df)
    assert lengths.tolist() == [1, 7, 300] and counts.tolist() == [1, 2, 1]
    assert packing.every_length(df.limit(0))[0].size == 0


def test_pipeline_packs_exactly(spark, monkeypatch):
    """The pipeline's last stage, too, takes every length as it is."""
    monkeypatch.setattr(packing, "MOST_LINES", 20)
    monkeypatch.setattr(packing, "EXACT", 4)
    monkeypatch.setattr(packing, "FINE", 1)
    n = np.random.default_rng(9).integers(0, 300, 200).tolist()
    docs = spark.createDataFrame([(i, "a " * k) for i, k in enumerate(n)], "doc_id long, text string")
    lengths, counts = np.unique(np.array(n) + 1, return_counts=True)
    out = corpus_pipeline.batches(spark, docs, "").collect()
    assert {r.padded for r in out} == set(packing.best_ends(lengths, counts, packing.BUCKETS))


def test_collocations_work_on_small_pieces():
    """Two megabytes of one language are several pieces, which keeps the arrays of a task small; no word is lost."""
    texts = [f"w{i} " * (50_000 // (len(str(i)) + 2)) for i in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(["en"] * len(texts))], names=["text", "lang"])
    parts = [runs for _, runs in collocations._by_language([batch])]
    assert max(len(runs.buf) for runs in parts) <= 1 << 19
    assert sum(runs.n for runs in parts) == sum(len(t.split()) for t in texts)
