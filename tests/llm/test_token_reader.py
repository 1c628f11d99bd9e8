"""Reads of token files keep the batch they stand in."""

import numpy as np
import pytest

from barsignal.llm.token_output import SequenceReader, SequenceWriter


def test_a_batch_is_decoded_once(tmp_path, monkeypatch):
    path = f"file://{tmp_path}/t/ids.arrow"
    out = SequenceWriter(path, np.dtype("<u2"), sequence=4, per_batch=3)
    ids = np.arange(1, 31, dtype="<u2")
    places = [out.append(ids[k : k + 3].tobytes()) for k in range(0, 30, 3)]
    out.close()
    decoded = []
    batch = SequenceReader.batch
    monkeypatch.setattr(SequenceReader, "batch", lambda self, k: decoded.append(k) or batch(self, k))
    reader = SequenceReader(path)
    assert [reader.tokens(p, 3).tolist() for p in places] == [ids[k : k + 3].tolist() for k in range(0, 30, 3)]
    assert decoded == [0, 1, 2]
    assert reader.tokens(0, 30).tolist() == ids.tolist()
    for place, n in ((29, 2), (30, 1), (31, 1), (28, 5)):
        with pytest.raises(ValueError):
            reader.tokens(place, n)
