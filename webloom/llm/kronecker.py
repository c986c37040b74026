"""Exact inner products of whole numbers, several candidates to one multiplication.

The components of several candidates are biased to be non-negative and laid into separated fields of
one wide integer, per dimension. An anchor multiplies that integer once per component; the sum over
all dimensions holds the inner product with every candidate in its own field, because no field can
reach into the next one: its width follows from the anchor's components and the largest biased one.

Where two fields or more fit 53 bits the wide integer is the whole number of a double, so that the
products are a matrix product and still exact. Components too large for that go into Python's
integers, which are as wide as it takes.
"""

from __future__ import annotations

import numpy as np

DOUBLE_BITS = 53
# Candidates to one of Python's integers.
LONG_FIELDS = 32
LOW, HIGH = -(2**63), 2**63 - 1


def _in_doubles(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray | None:
    """All products as 64-bit numbers, or None where not one field fits a double."""
    bias = max(0.0, -candidates.min(initial=0.0))
    reach = np.abs(anchors).sum(1).max(initial=0.0) * (candidates.max(initial=0.0) + bias)
    if not reach < 2.0 ** (DOUBLE_BITS - 2):
        return None
    width = (2 * int(reach) + 1).bit_length()  # a sum lies between -reach and reach, and is lifted by reach
    fields = max(1, min(DOUBLE_BITS // width, len(candidates)))
    rows = -(-len(candidates) // fields)
    wide = np.zeros((rows, candidates.shape[1]))
    for k in range(fields):
        part = candidates[k * rows : (k + 1) * rows]
        wide[: len(part)] += (part + bias) * 2.0 ** (k * width)
    lift = sum(int(reach) << (k * width) for k in range(fields))
    sums = (anchors @ wide.T).astype(np.int64) + lift
    own = (int(reach) + bias * anchors.sum(1)).astype(np.int64)[:, None]  # what bias and lift have added
    mask = (1 << width) - 1
    out = [((sums >> (k * width)) & mask) - own for k in range(fields)]
    return np.concatenate(out, axis=1)[:, : len(candidates)]


def _in_long_integers(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """The same for components of any size; products beyond 64 bits are cut to the nearest such number."""
    out = np.empty((len(anchors), len(candidates)), np.int64)
    asked = [[int(x) for x in a] for a in anchors]
    for at in range(0, len(candidates), LONG_FIELDS):
        part = [[int(x) for x in c] for c in candidates[at : at + LONG_FIELDS]]
        bias = max(0, -min(map(min, part), default=0)) if candidates.shape[1] else 0
        top = max(map(max, part), default=0) + bias if candidates.shape[1] else 0
        reach = max((sum(map(abs, a)) for a in asked), default=0) * top
        width = (2 * reach + 1).bit_length()
        wide = [sum((c[j] + bias) << (k * width) for k, c in enumerate(part)) for j in range(candidates.shape[1])]
        lift, mask = sum(reach << (k * width) for k in range(len(part))), (1 << width) - 1
        for i, a in enumerate(asked):
            total, own = sum(x * w for x, w in zip(a, wide)) + lift, reach + bias * sum(a)
            for k in range(len(part)):
                out[i, at + k] = min(max(((total >> (k * width)) & mask) - own, LOW), HIGH)
    return out


def products(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner product of every row of ``anchors`` with every row of ``candidates``, whole numbers as doubles."""
    fast = _in_doubles(anchors, candidates)
    if fast is not None:
        return fast
    large = np.abs(candidates).max(1, initial=0.0) >= 2.0**20, np.abs(anchors).max(1, initial=0.0) >= 2.0**20
    if large[0].all() or large[1].all() or not (large[0].any() or large[1].any()):
        return _in_long_integers(anchors, candidates)
    out = np.empty((len(anchors), len(candidates)), np.int64)  # a few large rows do not slow down the others
    for rows in (large[1], ~large[1]):
        for columns in (large[0], ~large[0]):
            if rows.any() and columns.any():
                out[np.ix_(rows, columns)] = products(anchors[rows], candidates[columns])
    return out
