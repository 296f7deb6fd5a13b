"""Features of few places are put together before rows are scored."""

import numpy as np

from amberline.operators import ensembles


def _nodes(trees=40, features=7):
    """Trees of three leaves: two thresholds each; all features but the last have few of them."""
    r = np.random.default_rng(3)
    starts, feature, threshold, left, right, value = [], [], [], [], [], []
    for t in range(trees):
        at = 5 * t
        starts.append(at)
        f = r.integers(0, features, 2)
        cut = np.where(f == features - 1, r.normal(size=2), r.integers(0, 3, 2))
        feature += [f[0], f[1], 0, 0, 0]
        threshold += [cut[0], cut[1], 0.0, 0.0, 0.0]
        left += [at + 1, at + 3, at + 2, at + 3, at + 4]
        right += [at + 2, at + 4, at + 2, at + 3, at + 4]
        value += list(r.normal(size=5))
    return ensembles.Nodes(np.array(starts), np.zeros(trees, np.int64), np.array(feature, np.int32), np.array(threshold), np.array(left, np.int32),
                           np.array(right, np.int32), np.array(value)[:, None])


def test_joint_places_give_the_sums_of_steps(monkeypatch):
    nodes, r = _nodes(), np.random.default_rng(4)
    x = np.where(np.arange(7) < 6, r.integers(-1, 4, (500, 7)), r.normal(size=(500, 7)))
    x[::50, 2], x[1::50, 6] = np.nan, np.inf
    wanted = ensembles.sums_by_steps(nodes, [0, 20])(x)
    for most in (1, 4, 256):
        monkeypatch.setattr(ensembles, "GROUP_PLACES", most)
        assert np.array_equal(ensembles.sums_by_masks(nodes, 7, [0, 20])(x), wanted)


def test_groups_are_bounded():
    places = [2, 40, 3, 5, 33, 4, 4, 2]
    groups = ensembles._grouped(places, 10_000)
    assert sorted(f for g in groups for f in g) == list(range(8)) and len(groups) == 3
    sizes = [int(np.prod([places[f] for f in g])) for g in groups]
    assert max(sizes) <= ensembles.GROUP_PLACES
    assert ensembles._grouped(places, sum(places)) and len(ensembles._grouped(places, sum(places))) >= 7
    assert ensembles._grouped([], 5) == []
