"""What near_dup can lose at the threshold: pairs without a common band, and pairs estimated too low."""

from __future__ import annotations

import math

from tidemark.llm import near_dup


def test_estimates_lose_less_than_bands():
    p, m = near_dup.SIMILAR / 100, near_dup.M
    bands = (1 - p**near_dup.BAND_REGISTERS) ** near_dup.BANDS
    below = math.ceil(m * (p - near_dup.MARGIN) - 1e-9)
    margin = sum(math.comb(m, k) * p**k * (1 - p) ** (m - k) for k in range(below))
    assert margin < bands / 100
    assert margin + bands < 3e-6
