"""Anchors with very many fingerprints, and odd distances, against all pairs."""

import numpy as np
import pytest

from paceline.llm import simhash
from paceline.llm.components import connected_components


def crowd(seed, n, spread):
    """Fingerprints around a few centres, a few bits away."""
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << 63, 3, dtype=np.int64).view(np.uint64)
    out = set()
    while len(out) < n:
        x = int(centres[rng.integers(3)])
        for b in rng.integers(0, 64, rng.integers(0, spread + 1)):
            x ^= 1 << int(b)
        out.add(x)
    return np.array(sorted(out), dtype=np.uint64)


def plain_components(fp, max_bits):
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= max_bits
    label = np.arange(len(fp))
    while True:
        new = np.where(near, label[None, :], len(fp)).min(axis=1)
        if (new == label).all():
            return label
        label = new


def groups(pairs, fp):
    """The least member of each value's component, from links."""
    place = {int(v): i for i, v in enumerate(fp)}
    label = list(range(len(fp)))
    changed = True
    while changed:
        changed = False
        for u, v in pairs:
            a, b = place[u], place[v]
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


@pytest.mark.parametrize("max_bits", [1, 2, 3])
def test_shared_neighbours_connect_what_all_pairs_connect(max_bits):
    fp = crowd(max_bits, 150, 4)
    left, right = simhash._links_shared(fp, max_bits)
    pairs = [(int(fp[a]), int(fp[b])) for a, b in zip(left, right)]
    assert all((u ^ v).bit_count() <= max_bits for u, v in pairs)
    assert groups(pairs, fp) == plain_components(fp, max_bits).tolist()


@pytest.mark.parametrize("max_bits", [1, 2])
def test_crowded_anchors_give_the_same_components(spark, max_bits):
    fp = crowd(7, 200, 3)
    prints = spark.createDataFrame([(int(v),) for v in fp.view(np.int64)] * 2 + [(None,)], "fp long")
    want = plain_components(fp, max_bits)
    for size in (10, 100_000):
        found = connected_components(simhash.fingerprint_links(prints, max_bits, size), "u", "v")
        pairs = [(r["node"] & (1 << 64) - 1, r["component"] & (1 << 64) - 1) for r in found.collect()]
        assert groups(pairs, fp) == want.tolist(), size
