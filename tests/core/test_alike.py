import difflib
import random

import pytest

from fundlens.functions import alike


@pytest.mark.parametrize("least", [0.8, 0.5])
def test_equal_to_difflib(least):
    rng = random.Random(3)
    some = lambda n: [" ".join(rng.choice(["road", "roads", "north", "school", "a1", "ab" * rng.randint(1, 30)]) for _ in range(rng.randint(0, 12))) for _ in range(n)]
    a, b = sorted({*some(60), "", "a" * 64, "a" * 70, "a" * 60 + "b" * 190}), sorted({*some(120), "", "a" * 63, "ab" * 32, "b" * 200 + "a" * 50, "a" * 300})
    x, y, r = alike.alike(alike.Names(a), alike.Names(b), least)
    want = {(i, j): difflib.SequenceMatcher(None, s, t).ratio() for i, s in enumerate(a) for j, t in enumerate(b)}
    assert dict(zip(zip(x.tolist(), y.tolist(), strict=True), r.tolist(), strict=True)) == {k: v for k, v in want.items() if v >= least}
