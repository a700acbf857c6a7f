"""op7: words of bytes that no language has seen keep their languages apart, whatever their length."""

import math

import numpy as np
import pytest

from railtable.llm import langid


@pytest.mark.parametrize("size", [1, 15, 16, 17, 30, 36, 39, 40, 41, 45, 80])
def test_unseen_bytes(size):
    keys = [b" "] + [bytes([b]) for b in range(256) if b != 32]
    probs = np.full((len(keys), 3), [1e-9, 3e-9, 2e-10])
    model = langid.Model(["a", "b", "c"], np.zeros(3), keys, probs)
    word = np.frombuffer(b" " + bytes([0xE0 + k % 16 for k in range(size - 1)]), np.uint8)
    got = langid.Scorer(model).words(word, np.array([0]), np.array([len(word)]))[0]
    assert all(math.isclose(x, size * math.log(p), rel_tol=1e-12) for x, p in zip(got, (1e-9, 3e-9, 2e-10), strict=True))
