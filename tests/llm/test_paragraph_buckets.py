"""The comparison inside one bucket against a plain loop over its pairs."""

from __future__ import annotations

import numpy as np

from quarrystone.llm import paragraphs


def plain(node, root, side, sets, similarity):
    group, found = {int(r): int(r) for r in root}, []

    def top(r):
        while group[r] != r:
            r = group[r]
        return r

    for i in np.flatnonzero(side).tolist():
        for j in range(len(sets)):
            x, y = top(int(root[i])), top(int(root[j]))
            if x != y and root[i] != root[j] and paragraphs.alike(sets[i], sets[j], similarity):
                group[max(x, y)] = min(x, y)
                found.append((int(node[j]), int(node[i])))
    return found


def test_bucket_equals_a_loop_over_pairs():
    rng = np.random.default_rng(1)
    links = 0
    for _ in range(20):
        count, base = int(rng.integers(1, 160)), rng.integers(0, 2**63, (4, 40)).astype(np.uint64)
        sets = []
        for _ in range(count):
            one, changed = base[rng.integers(4)].copy(), int(rng.integers(0, 9))
            one[rng.integers(0, 40, changed)] = rng.integers(0, 2**63, changed).astype(np.uint64)
            sets.append(np.unique(one[: int(rng.integers(1, 41))] if rng.random() < 0.3 else one))
        node = np.arange(count) * 3
        given = node, np.where(rng.random(count) < 0.3, 0, node), (rng.random(count) < 0.6).astype(int), sets, 0.8
        links += len(plain(*given))
        assert paragraphs._bucket(*given) == plain(*given)
    assert links > 100


def test_shared_counts_and_empty_sets():
    one, none = np.array([1, 4, 9], np.uint64), np.zeros(0, np.uint64)
    assert paragraphs.shared(one, [np.array([4, 9, 10], np.uint64), none, one]).tolist() == [2, 0, 3]
    assert paragraphs.shared(none, [one]).tolist() == [0] and paragraphs.shared(one, []).tolist() == []
