"""Vantage-point trees over 64-bit fingerprints under the Hamming distance.

A node holds a vantage fingerprint and a radius; a fingerprint goes inside if its distance to the
vantage is at most the radius, else outside. By the triangle bound two fingerprints that differ
in at most ``reach`` bits have distances to any vantage that differ by at most ``reach``, so
fingerprints inside but within ``reach`` of the border are also looked up outside, and then every
pair within reach meets in at least one leaf.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

# Vantages tried for a node; the one with the fewest fingerprints near its border is taken.
TRIED = 12
# Below this a set is compared pair by pair; the block of a comparison is bounded as well.
PLAIN = 192
ROWS_AT_ONCE = 1 << 21


def distance(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def best_split(points: np.ndarray, reach: int, seed: int) -> tuple[np.uint64, int] | None:
    """Vantage and radius that leave at least a quarter on either side and the least on the border.

    None if no tried vantage parts the points that well.
    """
    rng = np.random.default_rng([len(points), seed])
    looked_at = points if len(points) <= 20_000 else points[rng.integers(0, len(points), 20_000)]
    best = None
    for vantage in looked_at[rng.integers(0, len(looked_at), TRIED)]:
        counts = np.bincount(distance(looked_at, vantage), minlength=65)
        inside = np.cumsum(counts)
        for radius in range(64):
            share = inside[radius] / len(looked_at)
            if 0.25 <= share <= 0.75:
                border = counts[max(0, radius - reach + 1) : radius + 1].sum()
                if best is None or border < best[0]:
                    best = (border, vantage, radius)
    if best is None or best[0] > 0.5 * len(looked_at):
        return None
    return best[1], best[2]


def parts(points: np.ndarray, at: np.ndarray, split: tuple[np.uint64, int], reach: int):
    """Positions that go inside, and those looked up outside."""
    vantage, radius = split
    d = distance(points[at], vantage).astype(np.int16)
    return at[d <= radius], at[d > radius - reach]


@dataclass
class VantageTree:
    """The top of the tree, grown over a sample; its leaves are the shards of all fingerprints."""

    reach: int
    nodes: list[tuple[np.uint64, int, int, int]] = field(default_factory=list)
    root: int = -1
    leaves: int = 0

    @classmethod
    def grow(cls, sample: np.ndarray, leaf_size: int, reach: int) -> VantageTree:
        tree = cls(reach)
        tree.root = tree._grow(sample, leaf_size, 0)
        return tree

    def _grow(self, sample: np.ndarray, leaf_size: int, depth: int) -> int:
        split = best_split(sample, self.reach, depth) if len(sample) > leaf_size else None
        if split is None:
            self.leaves += 1
            return -self.leaves  # leaves count down from -1
        inner, outer = parts(sample, np.arange(len(sample)), split, self.reach)
        k = len(self.nodes)
        self.nodes.append((split[0], split[1], 0, 0))
        inside = self._grow(sample[inner], leaf_size, depth + 1)
        outside = self._grow(sample[outer], leaf_size, depth + 1)
        self.nodes[k] = (split[0], split[1], inside, outside)
        return k

    def route(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, shard) for every shard in which a point has to be looked up."""
        positions, shards = [], []
        todo = [(self.root, np.arange(len(points)))]
        while todo:
            node, at = todo.pop()
            if not len(at):
                continue
            if node < 0:
                positions.append(at)
                shards.append(np.full(len(at), -node - 1, np.int32))
                continue
            vantage, radius, inside, outside = self.nodes[node]
            inner, outer = parts(points, at, (vantage, radius), self.reach)
            todo += [(inside, inner), (outside, outer)]
        if not positions:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        return np.concatenate(positions), np.concatenate(shards)


def _merge_plain(points: np.ndarray, at: np.ndarray, label: np.ndarray, reach: int) -> None:
    """Give all that are linked among ``at`` the smallest label of their group, block by block."""
    own = points[at]
    step = max(1, ROWS_AT_ONCE // len(at))
    if len(at) <= step:
        near = distance(own[:, None], own[None, :]) <= reach
        if near.sum() == len(at):
            return
        while True:
            now = np.where(near, label[at][None, :], np.iinfo(np.int64).max).min(1)
            if (now == label[at]).all():
                return
            label[at] = now
    while True:
        before = label[at].copy()
        for i in range(0, len(at), step):
            near = distance(own[i : i + step, None], own[None, :]) <= reach
            label[at[i : i + step]] = np.where(
                near, label[at][None, :], np.iinfo(np.int64).max
            ).min(1)
        if (label[at] == before).all():
            return


def linked(points: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among distinct points, as a star for each group found: (position, position of centre).

    The tree goes on below the shard until a set is small or cannot be parted. A point near a
    border stands in several sets; the stars of those sets then share it, so no link is lost.
    """
    member, centre = [], []
    todo = [(np.arange(len(points)), 0)]
    while todo:
        at, depth = todo.pop()
        split = best_split(points[at], reach, depth) if len(at) > PLAIN else None
        if split is not None:
            inner, outer = parts(points, at, split, reach)
            if max(len(inner), len(outer)) < 0.9 * len(at):
                todo += [(inner, depth + 1), (outer, depth + 1)]
                continue
        if len(at) < 2:
            continue
        label = np.arange(len(points)) if len(at) == len(points) else _Sparse(at)
        _merge_plain(points, at, label, reach)
        own = label[at]
        moved = own != at
        member.append(at[moved])
        centre.append(own[moved])
    if not member:
        none = np.zeros(0, np.int64)
        return none, none
    both = np.unique(np.stack([np.concatenate(member), np.concatenate(centre)], 1), axis=0)
    return both[:, 0], both[:, 1]


class _Sparse:
    """Labels of a few positions of a large set, each its own label at first."""

    def __init__(self, at: np.ndarray):
        self.at = np.sort(at)
        self.own = self.at.copy()

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return self.own[np.searchsorted(self.at, at)]

    def __setitem__(self, at: np.ndarray, value: np.ndarray) -> None:
        self.own[np.searchsorted(self.at, at)] = value
