"""What the toxicity model learns from some hundred labels, and how words start."""

import zlib

import numpy as np
import pandas as pd

from barsignal.llm import toxicity

SF = "/root/testdata/sf0.01"


def test_few_labels_teach_the_plain_cases():
    docs = pd.read_parquet(f"{SF}/documents.parquet").merge(pd.read_parquet(f"{SF}/labels.parquet")[["doc_id", "toxic"]], on="doc_id")
    docs = docs[docs["toxic"].notna() & docs["text"].notna()].sort_values("doc_id")
    held = docs["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)
    train, test = docs[~held], docs[held]
    counts = train["toxic"].astype(int).value_counts().to_dict()
    model = toxicity.fit_toxicity(list(zip(train["text"], train["toxic"].astype(int), strict=True)), counts)
    named = model.score(test["text"].tolist()) >= toxicity.THRESHOLD
    toxic = test["toxic"].to_numpy() == 1
    assert named[toxic].mean() >= 0.5
    assert named[~toxic].mean() <= 0.05


def test_words_start_with_evidence_beyond_chance():
    toxic, texts = np.array([0, 3, 8, 12, 0, 60]), np.array([3, 3, 8, 100, 400, 60])
    start = toxicity._evidence(toxic, texts, 0.12)
    assert start[0] == start[3] == 0  # too few, or just their share
    assert 0 < start[1] < 0.2 < start[2] < start[5] == 3
    assert start[4] < 0
    assert (np.diff(toxicity._evidence(np.arange(20), np.full(20, 20), 0.5)) >= 0).all()
