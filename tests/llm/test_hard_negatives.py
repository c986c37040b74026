"""Packed products and hard negatives against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import MEDIUM, SMALL
from tools.check_oracle import connect, difference
from webloom.llm import hard_negatives as H
from webloom.llm.kronecker import products
from webloom.llm.queries import ORACLE_SQL, QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, label int, id int, score string"


@pytest.mark.parametrize("reach", [0, 1, 130, 40_000, 1 << 30, 1 << 70])
@pytest.mark.parametrize("dim", [0, 1, 64])
def test_packed_products_are_exact(reach, dim):
    rng = np.random.default_rng(reach % 97 + dim)
    a = np.floor(rng.uniform(-reach, reach + 1, (5, dim)))
    c = np.floor(rng.uniform(-reach, reach + 1, (71, dim)))
    if reach > 1000:
        c[3:60] = np.clip(c[3:60], -9, 9)  # large rows beside small ones
    want = [[min(max(sum(int(x) * int(y) for x, y in zip(p, q)), -(2**63)), 2**63 - 1) for q in c] for p in a]
    assert products(a, c).tolist() == want


@pytest.mark.parametrize("sf_dir", [SMALL, MEDIUM])
def test_query_equals_its_sql(llm_spark, sf_dir):
    name = "op11_kronecker_negatives"
    assert difference(QUERIES[name](llm_spark, sf_dir), connect(sf_dir), ORACLE_SQL[name]) is None


def plain(rows):
    use = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(np.float32(x)) for x in v):
            continue
        whole = [int(np.floor(256 * float(np.float32(x)))) for x in v]
        use.append((i, (label + 1) % 10 if i % 7 == 0 else label, whole))
    out = []
    for a, la, va in use:
        if a % 100:
            continue
        scores = [(-sum(x * y for x, y in zip(va, v)), i, label) for i, label, v in use if i != a and len(v) == len(va)]
        for p, pi, _ in sorted(s for s in scores if s[2] == la)[:5]:
            near = sorted(s for s in scores if s[2] != la and 80 * -p <= 100 * -s[0] <= 100 * -p)[:5]
            out += [(a, pi, k + 1, n, -p, -s) for k, (s, n, _) in enumerate(near)]
    return sorted(out)


def made(seed, n, dims):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.3, rng.choice(dims))], int(rng.integers(3))) for i in range(n)]
    same = rows[0][1]
    rows = [(i, same, label) if i % 3 == 0 else (i, v, label) for i, v, label in rows]  # a third is one vector
    rows += [(200, rows[1][1], 1), (200, rows[1][1], 1), (None, same, 1), (300, None, 1), (301, [1.0, None], 1)]
    rows += [(302, [float("inf")] * 8, 2), (303, [float("nan")] * 8, 2), (304, same, None), (400, [], 1), (403, [], 2)]
    return rows + [(405, [], 1), (500, [-0.5] * 8, 1), (-700, same, 9), (501, [0.5] * 8, 1), (503, [0.5] * 8, 2)]


def test_against_a_plain_version(llm_spark):
    rows = made(3, 400, [8, 5])
    given = llm_spark.createDataFrame([(*r, 1, "s") for r in rows], SCHEMA)
    got = H.mined(H.labelled(given), F.col("id") % 100 == 0).collect()
    assert sorted(map(tuple, got)) == plain(rows)


def test_blocks_and_tiles_change_nothing(llm_spark, monkeypatch):
    rows = made(5, 300, [8])
    given = llm_spark.createDataFrame([(*r, 1, "s") for r in rows], SCHEMA).repartition(5)
    monkeypatch.setattr(H, "ANCHOR_BYTES", 300)
    monkeypatch.setattr(H, "GATHERED", 64)
    monkeypatch.setattr(H, "TILE", 16)
    got = H.mined(H.labelled(given), F.col("id") % 100 == 0).collect()
    assert sorted(map(tuple, got)) == plain(rows)


def test_empty_tables(llm_spark):
    empty = llm_spark.createDataFrame([], SCHEMA)
    assert H.mined(H.labelled(empty), F.col("id") % 100 == 0).collect() == []


def test_scores_beyond_64_bits_are_cut(llm_spark):
    big = [3e30] * 8
    rows = [(100, big, 1), (101, big, 1), (102, big, 2), (103, [-x for x in big], 3)]
    given = llm_spark.createDataFrame([(*r, 1, "s") for r in rows], SCHEMA)
    top = 2**63 - 1
    assert [tuple(r) for r in H.mined(H.labelled(given), F.col("id") == 100).collect()] == [(100, 101, 1, 102, top, top)]
