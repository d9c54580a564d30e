from math import comb
from pathlib import Path

from tesserae.llm import minhash_dedup as m


def test_stated_loss_is_that_of_the_constants():
    loss = sum(comb(m.COORDINATES, k) * 3**k for k in range(m.MATCHES)) / 4**m.COORDINATES
    said = f"{1e6 * loss:.1f}"
    assert f"all but {said} pairs in a million" in m.__doc__
    assert f"a probability of {said} in a million" in (Path(__file__).parents[2] / "README.md").read_text()
