"""Features of texts: byte classes in one count, powers of the word hash made once."""

import numpy as np
import pyarrow as pa

from attrition.llm import quality


def test_powers_are_made_once(monkeypatch):
    """Check finding: both tables of powers were multiplied out again for every slice of text."""
    part = pa.RecordBatch.from_pydict({"text": ["Ab b ab|!\n9%", None, "", "é,"]})
    first, calls, plain = quality.text_features(part), [], np.cumprod
    monkeypatch.setattr(np, "cumprod", lambda *a, **k: calls.append(1) or plain(*a, **k))
    again = quality.text_features(part)
    assert not calls
    assert all(np.array_equal(a, b) for x, y in zip(first, again) for a, b in zip(x, y))
    shares = [v[-quality.SHARES:] for _, v in first]
    counts = [1, 1, 1, 1, 1, 1, 0, 3, 0]
    assert np.allclose(shares[0], quality.SHARE_WEIGHT * np.sqrt(np.r_[np.array(counts) / 12, 1]))
    assert not shares[1].any() and not shares[2].any()
    assert np.allclose(shares[3], quality.SHARE_WEIGHT * np.sqrt(np.r_[np.array([0, 0, 0, 0, 0, 0, 1, 0, 2]) / 3, 1]))
