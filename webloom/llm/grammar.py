"""Re-Pair grammar compression of token ids, and the shard format that holds it.

A shard keeps its ids as symbols of a grammar: symbols below the vocabulary size are ids, the
others are rules of two symbols each. Every round counts all adjacent pairs of the shard, turns the
most frequent one, and those at most ``SHARE`` times rarer, into rules and replaces them, left to right
without overlap, until no pair occurs ``LEAST_COUNT`` times. No pair spans two documents, so a document
is a slice of the symbols and any of its ids can be reached through the expansion lengths of the rules.

Layout, little-endian: MAGIC, six uint32 (version, vocabulary, documents, rules, symbols, symbol
width in bytes), rules (left, right) uint32, expansion lengths uint32, per document: ids uint64
and symbols uint64, then the symbols.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

MAGIC = b"RPG1"
LEAST_COUNT = 8
SHARE = 64
_BUCKETS = 18


def _bucket(key: np.ndarray) -> np.ndarray:
    mixed = key * np.uint64(0x9E3779B97F4A7C15)
    mixed >>= np.uint64(64 - _BUCKETS)
    return mixed.view(np.int64)


def _frequent(
    key: np.ndarray, least: int, share: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The most frequent keys in ascending order, the places that hold one with its index, and the places
    of all keys that may occur ``least`` times.

    The most frequent keys occur ``least`` times and at least ``1 / share`` as often as the first of them.
    """
    # a sort alone is far cheaper than one that keeps the positions
    ordered = np.sort(key)
    ends = np.append(np.flatnonzero(ordered[1:] != ordered[:-1]), len(ordered) - 1)
    counts = np.diff(ends, prepend=-1)
    enough = counts >= least
    keys, counts = ordered[ends[enough]], counts[enough]
    if not len(keys):
        return keys, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    held = np.zeros(1 << _BUCKETS, dtype=bool)
    held[_bucket(keys)] = True
    kept = np.flatnonzero(held[_bucket(key)])
    chosen = keys[counts >= counts.max() / share]
    # nearly all places of a bucket with one chosen key hold that key; the others are looked up
    own, mine = key[kept], _bucket(chosen)
    index = np.full(1 << _BUCKETS, -1, np.int32)
    index[mine] = np.arange(len(chosen), dtype=np.int32)
    rule = index[_bucket(own)]
    at = np.flatnonzero(rule >= 0)
    rule, own = rule[at], own[at]
    hit = chosen[rule] == own
    if np.count_nonzero(index >= 0) < len(mine):
        missed = np.flatnonzero(~hit)
        again = np.minimum(np.searchsorted(chosen, own[missed]), len(chosen) - 1)
        found = chosen[again] == own[missed]
        rule[missed[found]], hit[missed[found]] = again[found], True
    return chosen, kept[at[hit]], rule[hit], kept


def compress(
    ids: np.ndarray, doc_ids: np.ndarray, vocabulary: int, least: int = LEAST_COUNT, share: int = SHARE
) -> bytes:
    """The shard of the concatenated ``ids`` of documents with ``doc_ids[i]`` ids each."""
    symbols = np.array(ids, dtype=np.uint32)
    last = np.zeros(len(symbols), dtype=bool)
    ends = np.cumsum(doc_ids)
    last[ends[doc_ids > 0] - 1] = True
    rules, lengths = [np.zeros((0, 2), np.uint32)], [np.ones(vocabulary, np.int64)]
    known = vocabulary
    # Occurrences of a pair all arise in the round that makes its newer symbol and only get fewer, so a pair
    # that is rare once stays so: only places that may still belong to a frequent one are looked at.
    open_places = np.flatnonzero(~last[:-1]) if len(symbols) else np.zeros(0, np.int64)
    while len(open_places):
        key = symbols[open_places].astype(np.uint64)
        key <<= np.uint64(32)
        key |= symbols[open_places + 1]
        pairs, hit, rule, kept = _frequent(key, least, share)
        if not len(pairs):
            break
        # of overlapping hits every second one counts, from the left
        hit, open_places = open_places[hit], open_places[kept]
        new_run = np.diff(hit, prepend=-2) > 1
        start = np.maximum.accumulate(np.where(new_run, hit, 0))
        taken = (hit - start) % 2 == 0
        hit, rule = hit[taken], rule[taken]
        symbols[hit] = known + rule
        last[hit] = last[hit + 1]
        keep = np.ones(len(symbols), dtype=bool)
        keep[hit + 1] = False
        again = np.zeros(len(symbols), dtype=bool)
        again[open_places] = again[hit] = True
        again[hit[hit > 0] - 1] = True
        again &= ~last
        symbols, last, again = symbols[keep], last[keep], again[keep]
        open_places = np.flatnonzero(again)
        pair = np.stack([pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32)
        so_far = np.concatenate(lengths)
        lengths.append(so_far[pair[:, 0]] + so_far[pair[:, 1]])
        rules.append(pair)
        known += len(pairs)
    per_doc = np.zeros(len(doc_ids), np.uint64)
    per_doc[doc_ids > 0] = np.diff(np.flatnonzero(last), prepend=-1)
    rule_table, rule_lengths = np.concatenate(rules), np.concatenate(lengths)[vocabulary:]
    width = 2 if known <= 1 << 16 else 4
    return b"".join(
        [
            MAGIC,
            struct.pack("<6I", 1, vocabulary, len(doc_ids), len(rule_table), len(symbols), width),
            rule_table.astype("<u4").tobytes(),
            rule_lengths.astype("<u4").tobytes(),
            np.asarray(doc_ids).astype("<u8").tobytes(),
            per_doc.astype("<u8").tobytes(),
            symbols.astype(f"<u{width}").tobytes(),
        ]
    )


@dataclass
class Shard:
    """A shard that has been read: documents, or parts of them, by position."""

    vocabulary: int
    rules: np.ndarray
    lengths: np.ndarray
    doc_ids: np.ndarray
    symbol_start: np.ndarray
    symbols: np.ndarray

    @classmethod
    def read(cls, blob: bytes) -> Shard:
        if blob[:4] != MAGIC:
            raise ValueError("not a grammar shard")
        version, vocabulary, docs, rules, symbols, width = struct.unpack_from("<6I", blob, 4)
        if version != 1:
            raise ValueError(f"shard version {version}")
        at = 28

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(blob, kind, n, at)
            at += out.nbytes
            return out

        table = take("<u4", 2 * rules).reshape(-1, 2).astype(np.int64)
        lengths = take("<u4", rules).astype(np.int64)
        doc_ids, per_doc = take("<u8", docs).astype(np.int64), take("<u8", docs).astype(np.int64)
        start = np.concatenate([[0], np.cumsum(per_doc)])
        return cls(vocabulary, table, lengths, doc_ids, start, take(f"<u{width}", symbols))

    def __post_init__(self) -> None:
        """Expansions of all rules, flat: a rule only names ids and earlier rules, so many are expanded at once."""
        self.offset = np.concatenate([[0], np.cumsum(self.lengths)])
        self.flat = np.zeros(self.offset[-1], np.uint32)
        latest = self.rules.max(1, initial=0) - self.vocabulary
        first = 0
        while first < len(self.rules):
            waiting = np.flatnonzero(latest[first:] >= first)
            end = first + int(waiting[0]) if len(waiting) else len(self.rules)
            self.flat[self.offset[first] : self.offset[end]] = self.expand(self.rules[first:end].reshape(-1))
            first = end

    def sizes(self, symbols: np.ndarray) -> np.ndarray:
        out = np.ones(len(symbols), np.int64)
        rule = symbols >= self.vocabulary
        out[rule] = self.lengths[symbols[rule].astype(np.int64) - self.vocabulary]
        return out

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        sizes = self.sizes(symbols)
        start = np.cumsum(sizes) - sizes
        out = np.empty(int(sizes.sum()), np.uint32)
        rule = symbols >= self.vocabulary
        out[start[~rule]] = symbols[~rule]
        if rule.any():
            n, to = sizes[rule], start[rule]
            of = self.offset[symbols[rule].astype(np.int64) - self.vocabulary]
            step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            out[np.repeat(to, n) + step] = self.flat[np.repeat(of, n) + step]
        return out

    def document(self, i: int) -> np.ndarray:
        """All ids of the i-th document."""
        return self.expand(self.symbols[self.symbol_start[i] : self.symbol_start[i + 1]])

    def part(self, i: int, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the i-th document: only the symbols over them are expanded."""
        own = self.symbols[self.symbol_start[i] : self.symbol_start[i + 1]]
        ends = np.cumsum(self.sizes(own))
        first = int(np.searchsorted(ends, start, "right"))
        past = int(np.searchsorted(ends, stop, "left")) + 1
        skipped = int(ends[first - 1]) if first else 0
        return self.expand(own[first:past])[start - skipped : stop - skipped]
