"""Trees on rows known by the places of their features, grown in one task with numpy.

What Spark ML's boosted classifier does, tree by tree: the first tree is fitted to the labels -1 and 1, each later one to the negative gradients of the logistic loss at the margins
so far; splits are those of the largest fall in variance.  A level of a tree is one pass over the rows in blocks: rows go to their node of the level, and are added up
by node and place.  Features are put together into codes, so that one count serves several of them; of two sisters only the one with fewer rows is counted.

Gradients are added up as whole numbers of 2 ** -24, so sums do not depend on the order of rows.  The module needs numpy alone and is sent along with the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

#: Places of the features that share a code, at most.
CODE_PLACES = 1024
#: Rows of a block: its arrays stay in a core's cache.
BLOCK = 1 << 16
UNIT = float(1 << 24)
#: A fall in variance up to this is rounding.
NOTHING = 1e-12


def joined(places: Sequence[int], depth: int = 0) -> list[list[int]]:
    """Numbers of features put together, the largest first, while a code has at most ``CODE_PLACES`` values, fewer for trees of very many nodes."""
    most = CODE_PLACES >> max(0, depth - 7)
    groups: list[list[int]] = []
    sizes: list[int] = []
    for f in sorted(range(len(places)), key=lambda f: (-places[f], f)):
        at = next((i for i, s in enumerate(sizes) if s * places[f] <= most), None)
        if at is None:
            groups.append([f])
            sizes.append(places[f])
        else:
            groups[at].append(f)
            sizes[at] *= places[f]
    return groups


def coded(x: np.ndarray, cuts: Sequence[np.ndarray], groups: Sequence[Sequence[int]]) -> np.ndarray:
    """Codes (groups, rows) of values (rows, features); the place of a value is the number of cuts below it."""
    out = np.zeros((len(groups), len(x)), np.uint16)
    for j, group in enumerate(groups):
        code = np.zeros(len(x), np.int64)
        for f in group:
            code = code * (len(cuts[f]) + 1) + np.searchsorted(cuts[f], x[:, f])
        out[j] = code
    return out


def placed(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """Places (rows, features) of values, of which a feature has 256 at most."""
    return np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)], axis=1).astype(np.uint8)


@dataclass
class Settings:
    rounds: int
    depth: int
    step: float
    share: float        # of the rows that a tree is fitted on
    features: int       # that a node chooses from
    least_rows: int
    least_gain: float
    seed: int


@dataclass
class Layout:
    """How codes are made of places."""

    places: list[int]
    groups: list[list[int]]

    def __post_init__(self):
        self.sizes = [int(np.prod([self.places[f] for f in g])) for g in self.groups]
        self.group_of = np.zeros(len(self.places), np.int64)
        self.place_of: dict[int, np.ndarray] = {}  # of each code, by feature
        for j, group in enumerate(self.groups):
            stride = self.sizes[j]
            for f in group:
                stride //= self.places[f]
                self.group_of[f] = j
                self.place_of[f] = np.arange(self.sizes[j]) // stride % self.places[f]
        self.starts = np.cumsum([0, *self.places])
        self.feature_of = np.repeat(np.arange(len(self.places)), self.places)

    def by_feature(self, j: int, counted: np.ndarray, out: np.ndarray) -> None:
        """Adds what was counted by code, (..., codes), to ``out``, (..., places of all features)."""
        group = self.groups[j]
        cube = counted.reshape(*counted.shape[:-1], *[self.places[f] for f in group])
        lead = counted.ndim - 1
        for i, f in enumerate(group):
            others = tuple(lead + o for o in range(len(group)) if o != i)
            out[..., self.starts[f]:self.starts[f + 1]] += cube.sum(axis=others) if others else cube


class Tree:
    """Nodes in the order they were made: children come after their parent and side by side."""

    def __init__(self):
        self.feature, self.place, self.left, self.gain = [-1], [-1], [-1], [-1.0]

    def split(self, node: int, feature: int, place: int, gain: float) -> int:
        self.feature[node], self.place[node], self.left[node], self.gain[node] = feature, place, len(self.feature), gain
        for column, value in ((self.feature, -1), (self.place, -1), (self.left, -1), (self.gain, -1.0)):
            column += [value, value]
        return self.left[node]


def boosted_trees(codes: np.ndarray, layout: Layout, kind: np.ndarray, own: int, weights: Sequence[float] | None, settings: Settings) -> Iterator[dict]:
    """The trees, one after the other, of the booster that tells class ``own`` from the others.

    ``kind`` has the class of each row, ``weights`` the weight of each class, none where all rows weigh the same.
    """
    rows, draws = codes.shape[1], np.random.default_rng([settings.seed, own])
    flat, classes = codes.reshape(-1), 1 if weights is None else len(weights)
    scale = np.ones(1) if weights is None else np.asarray(weights, float)
    margins, unit = np.zeros(rows), np.empty(rows)
    node, numbers = np.empty(rows, np.int16 if settings.depth < 14 else np.int32), np.arange(min(BLOCK, rows))
    blocks = [slice(a, min(a + BLOCK, rows)) for a in range(0, rows, BLOCK)]
    last_places = layout.starts[1:] - 1

    def counts(slot_of: np.ndarray, slots: int, tables) -> np.ndarray:
        """Sends the rows of the level before to their children and adds up the nodes that have a slot: (slots, rows and sum, classes, places)."""
        sums = [np.zeros((2, classes, slots, size)) for size in layout.sizes]
        for b in blocks:
            if tables is not None:
                route(b, *tables)
            slot = slot_of.take(node[b])
            own_rows = np.flatnonzero((slot >= 0) if kept is None else (slot >= 0) & kept[b])
            at, g = slot.take(own_rows).astype(np.int64), unit[b].take(own_rows)
            if classes > 1:
                at += kind[b].take(own_rows).astype(np.int64) * slots
            for j, size in enumerate(layout.sizes):
                key = at * size + codes[j, b].take(own_rows)
                sums[j][0] += np.bincount(key, minlength=classes * slots * size).reshape(classes, slots, size)
                sums[j][1] += np.bincount(key, weights=g, minlength=classes * slots * size).reshape(classes, slots, size)
        out = np.zeros((2, classes, slots, layout.starts[-1]))
        for j in range(len(sums)):
            layout.by_feature(j, sums[j], out)
        return out.transpose(2, 0, 1, 3)

    def route(b: slice, group_of: np.ndarray, offset_of: np.ndarray, left_of: np.ndarray, right: np.ndarray) -> None:
        at = node[b]
        code = flat.take(group_of.take(at) * rows + (numbers[:len(at)] + b.start))
        node[b] = left_of.take(at) + right.take(offset_of.take(at) + code)

    def best_splits(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place (among those of all features) of the best split of each node and its gain."""
        running = sums.cumsum(axis=3)
        before = np.concatenate([np.zeros_like(running[..., :1]), running[..., layout.starts[1:-1] - 1]], axis=3)
        left = running - before[..., layout.feature_of]
        whole = left[..., last_places[:1]]
        (n_l, w_l, s_l), (n_r, w_r, s_r), (_, w, s) = (
            (x[:, 0].sum(axis=1), np.einsum("kct,c->kt", x[:, 0], scale), np.einsum("kct,c->kt", x[:, 1], scale) / UNIT) for x in (left, whole - left, whole))
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = (s_l * s_l / w_l + s_r * s_r / w_r - s * s / w) / w
        fit = (n_l >= max(1, settings.least_rows)) & (n_r >= max(1, settings.least_rows))
        if settings.features < len(layout.places):
            chosen = draws.random((len(sums), len(layout.places))).argsort(axis=1) < settings.features
            fit &= chosen[:, layout.feature_of]
        gain = np.where(fit & (gain >= settings.least_gain) & (gain > NOTHING), gain, -1.0)
        at = gain.argmax(axis=1)
        return at, gain[np.arange(len(sums)), at]

    for t in range(settings.rounds):
        kept = draws.random(rows, np.float32) < settings.share if settings.share < 1.0 else None
        for b in blocks:
            y = np.where(kind[b] == own, 1.0, -1.0)
            with np.errstate(over="ignore"):
                np.rint((y if t == 0 else 4.0 * y / (1.0 + np.exp(2.0 * y * margins[b]))) * UNIT, out=unit[b])
        node[:] = 0
        tree, tables = Tree(), None
        level, sums = [0], counts(np.zeros(1, np.int16), 1, None)
        totals = {0: sums[0, :, :, :layout.places[0]].sum(axis=2)}  # (rows and sum, classes)
        for depth in range(settings.depth):
            places, gains = best_splits(sums)
            split = [(i, v) for i, v in enumerate(level) if gains[i] > 0]
            if not split:
                break
            count = len(tree.feature) + 2 * len(split)
            group_of, offset_of, left_of = np.zeros(count, np.int64), np.zeros(count, np.int64), np.arange(count, dtype=np.int64)
            right, filled = [np.zeros(max(layout.sizes), np.int8)], max(layout.sizes)
            slot_of, pairs = np.full(count, -1, np.int16), []
            for i, v in split:
                at = int(places[i])
                f = int(layout.feature_of[at])
                child = tree.split(v, f, at - int(layout.starts[f]), float(gains[i]))
                group_of[v], offset_of[v], left_of[v] = layout.group_of[f], filled, child
                right.append((layout.place_of[f] > tree.place[v]).astype(np.int8))
                filled += len(right[-1])
                totals[child] = sums[i, :, :, layout.starts[f]:at + 1].sum(axis=2)
                totals[child + 1] = totals[v] - totals[child]
                small = child if totals[child][0].sum() <= totals[child + 1][0].sum() else child + 1
                slot_of[small] = len(pairs)
                pairs.append((i, child, small))
            tables = (group_of, offset_of, left_of, np.concatenate(right))
            level = [c for _, child, _ in pairs for c in (child, child + 1)]
            if depth == settings.depth - 1:
                break
            counted = counts(slot_of, len(pairs), tables)
            tables, parents = None, sums
            sums = np.empty((len(level), *counted.shape[1:]))
            for p, (i, child, small) in enumerate(pairs):
                sums[2 * p + (small - child)] = counted[p]
                sums[2 * p + 1 - (small - child)] = parents[i] - counted[p]
        yield _finished(tree, totals, scale, node, margins, unit, kind, kept, blocks, route, tables, 1.0 if t == 0 else settings.step, classes)


def _finished(tree: Tree, totals: dict, scale: np.ndarray, node, margins, unit, kind, kept, blocks, route, tables, factor: float, classes: int) -> dict:
    """Sends the rows to their leaves, adds the tree to the margins, and gives its nodes."""
    size = len(tree.feature)
    total = np.stack([totals[v] for v in range(size)])
    weight, said = total[:, 0] @ scale, total[:, 1] @ scale / UNIT
    with np.errstate(divide="ignore", invalid="ignore"):
        value = np.where(weight > 0, said / weight, 0.0)
    squares = np.zeros(size)
    for b in blocks:
        if tables is not None:
            route(b, *tables)
        margins[b] += factor * value.take(node[b])
        squared = (unit[b] / UNIT) ** 2 * (scale.take(kind[b]) if classes > 1 else 1.0)
        squares += np.bincount(node[b], weights=squared if kept is None else squared * kept[b], minlength=size)
    left = np.array(tree.left)
    for v in range(size - 1, -1, -1):
        if left[v] >= 0:
            squares[v] = squares[left[v]] + squares[left[v] + 1]
    impurity = np.maximum(squares / np.where(weight > 0, weight, 1.0) - value * value, 0.0)
    return {"feature": np.array(tree.feature), "place": np.array(tree.place), "left": left, "gain": np.array(tree.gain), "rows": total[:, 0].sum(axis=1).astype(np.int64),
            "stats": np.stack([weight, said, squares], axis=1), "value": value, "impurity": impurity}


def forest_tree(places: np.ndarray, bins: int, kind: np.ndarray, weights: np.ndarray, settings: Settings, tree: int, bootstrap: bool) -> dict:
    """One tree of a forest, as Spark ML grows it: rows are drawn with replacement, splits are those of the largest fall in Gini impurity among the features drawn for
    a node, and sister leaves that say the same class are put together.

    ``places`` has a row for each row, ``weights`` the weight of each class.
    """
    draws, width, classes = np.random.default_rng([settings.seed, tree]), places.shape[1], len(weights)
    times = draws.poisson(settings.share, len(places)) if bootstrap else (draws.random(len(places)) < settings.share) * 1
    rows = np.flatnonzero(times)
    flat, times, kind = places[rows].reshape(-1), times[rows].astype(float), kind[rows].astype(np.int64)
    slot = np.zeros(len(rows), np.int32)  # among the nodes of the level; -1 in a leaf
    numbers = np.arange(BLOCK) * width
    totals = [np.bincount(kind, weights=times, minlength=classes)[None]]
    feature, place, left, gains = [np.full(1, -1)], [np.full(1, -1)], [np.full(1, -1)], [np.full(1, -1.0)]
    size = 1
    for _ in range(settings.depth):
        own = totals[-1]
        level = len(own)
        chosen = draws.random((level, width)).argsort(axis=1)[:, :settings.features]
        picked = chosen.shape[1]
        counted = np.zeros((picked, level * classes * bins))
        for a in range(0, len(rows), BLOCK):
            at = slot[a:a + BLOCK]
            here = np.flatnonzero(at >= 0)
            if not len(here):
                continue
            at, n = at.take(here).astype(np.int64), times[a:a + BLOCK].take(here)
            base, start = (at * classes + kind[a:a + BLOCK].take(here)) * bins, numbers.take(here) + a * width
            for j in range(picked):
                counted[j] += np.bincount(base + flat.take(start + chosen[:, j].take(at)), weights=n, minlength=counted.shape[1])
        low = counted.reshape(picked, level, classes, bins).cumsum(axis=3)
        low, high = low, low[..., -1:] - low
        weight = weights[:, None]
        n_l, n_r, w_l, w_r = low.sum(axis=2), high.sum(axis=2), (low * weight).sum(axis=2), (high * weight).sum(axis=2)
        whole = own * weights
        w = whole.sum(axis=1)[:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = (((low * weight) ** 2).sum(axis=2) / w_l + ((high * weight) ** 2).sum(axis=2) / w_r - (whole * whole).sum(axis=1)[:, None] / w) / w
        least = max(1, settings.least_rows)
        gain = np.where((n_l >= least) & (n_r >= least) & (gain >= settings.least_gain) & (gain > NOTHING), gain, -1.0)
        gain = gain.transpose(1, 0, 2).reshape(level, -1)
        best = gain.argmax(axis=1)
        found = gain[np.arange(level), best]
        split = np.flatnonzero(found > 0)
        if not len(split):
            break
        j, cut = best // bins, best % bins
        used = chosen[np.arange(level), j]
        feature[-1], place[-1] = np.where(found > 0, used, -1), np.where(found > 0, cut, -1)
        rank = np.full(level, -1)
        rank[split] = np.arange(len(split))
        left[-1], gains[-1] = np.where(rank >= 0, size + 2 * rank, -1), np.where(found > 0, found, -1.0)
        size += 2 * len(split)
        lower = low[j[split], split, :, cut[split]]
        totals.append(np.stack([lower, own[split] - lower], axis=1).reshape(-1, classes))
        for column, empty in ((feature, -1), (place, -1), (left, -1), (gains, -1.0)):
            column.append(np.full(2 * len(split), empty))
        for a in range(0, len(rows), BLOCK):
            at = slot[a:a + BLOCK]
            here = np.flatnonzero(at >= 0)
            at = at.take(here)
            right = flat.take(numbers.take(here) + a * width + used.take(at)) > cut.take(at)
            slot[a:a + BLOCK][here] = np.where(rank.take(at) >= 0, 2 * rank.take(at) + right, -1)
    return _pruned(*[np.concatenate(x) for x in (feature, place, left, gains, totals)], weights)


def _pruned(feature, place, left, gain, total, weights: np.ndarray) -> dict:
    weighted = total * weights
    said = weighted.argmax(axis=1)
    for v in range(len(left) - 1, -1, -1):
        if (a := left[v]) >= 0 and left[a] < 0 and left[a + 1] < 0 and said[a] == said[a + 1]:
            left[v], feature[v], place[v], gain[v] = -1, -1, -1, -1.0
    order = [0]  # of the nodes that are left, children after their parent and side by side
    for v in order:
        if left[v] >= 0:
            order += [left[v], left[v] + 1]
    number = np.full(len(left), -1)
    number[order] = np.arange(len(order))
    kept = np.array(order)
    w = weighted[kept].sum(axis=1)
    impurity = 1.0 - (weighted[kept] ** 2).sum(axis=1) / np.where(w > 0, w * w, 1.0)
    return {"feature": feature[kept], "place": place[kept], "left": np.where(left[kept] >= 0, number[left[kept]], -1), "gain": gain[kept], "rows": total[kept].sum(axis=1).astype(np.int64),
            "stats": weighted[kept], "value": said[kept].astype(float), "impurity": impurity}
