"""Trees of several hundred leaves, as whole training sets give: masks of many words and steps agree."""

import numpy as np
import pytest

from amberline.operators.ensembles import Nodes, sums_by_masks, sums_by_steps


@pytest.mark.parametrize("depth", [3, 6, 9, 11])
def test_masks_of_many_words(depth):
    draws, size, trees = np.random.default_rng(7), 2 ** (depth + 1) - 1, 3
    at = np.arange(size)
    inner = at < 2 ** depth - 1
    left, right = np.where(inner, 2 * at + 1, at), np.where(inner, 2 * at + 2, at)
    starts = np.arange(trees) * size
    thresholds = draws.normal(size=(trees * size)).round(1)
    nodes = Nodes(starts, np.zeros(trees, int), draws.integers(0, 4, trees * size).astype(np.int32), thresholds, (left + starts[:, None]).ravel().astype(np.int32),
                  (right + starts[:, None]).ravel().astype(np.int32), draws.normal(size=(trees * size, 2)))
    x = draws.normal(size=(500, 4)).round(1)
    assert np.allclose(sums_by_masks(nodes, 4, [0, 1])(x), sums_by_steps(nodes, [0, 1])(x), atol=1e-12)
