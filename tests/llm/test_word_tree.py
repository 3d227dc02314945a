"""The second factor of the language model: a token's share of its class depends on the tokens before it."""

from __future__ import annotations

import random

import numpy as np

from editsieve.llm import maxent_lm as lm


def _keys(words):
    return np.array([lm.token_key(w) for w in words], dtype=np.uint64)


def _tree(keys, depth):
    probe = lm.WordTree(depth, np.zeros(lm.CLASSES << depth), np.zeros(lm.CLASSES << depth), 12)
    n = np.bincount(probe.leaf(keys), minlength=lm.CLASSES << depth).astype(float)
    v = np.bincount(probe.leaf(np.unique(keys)), minlength=lm.CLASSES << depth).astype(float)
    return lm.WordTree(depth, n, v, 16)


def _within(tree, word_keys, counts, back):
    """Probability within its class of each word, after the same two tokens."""
    n = len(word_keys)
    return 10 ** (tree.log10(word_keys, [np.full(n, b, dtype=np.uint64) for b in back]) + np.log10(counts + 1.0))


def test_shares_of_a_class_sum_to_one_and_without_weights_are_those_of_the_counts():
    rng = random.Random(3)
    words = [f"w{rng.randrange(300)}ing".encode() for _ in range(4000)]
    keys = _keys(words)
    for depth in (0, 1, 5):
        tree = _tree(keys, depth)
        for table in (tree.table, np.random.default_rng(1).normal(size=len(tree.table))):
            tree = lm.WordTree(depth, tree.leaf_n, tree.leaf_v, tree.bits, table)
            known, n = np.unique(keys, return_counts=True)
            group = int(known[0] & np.uint64(15))
            mine = (known & np.uint64(15)) == group
            share = _within(tree, known[mine], n[mine], [5, 9])
            # One place for unknown tokens per leaf.
            leaves = (np.arange(1 << depth, dtype=np.uint64) << np.uint64(4)) | np.uint64(group)
            unknown = _within(tree, leaves, np.zeros(1 << depth), [5, 9])
            assert abs(share.sum() + unknown.sum() - 1) < 1e-5
        flat = _within(_tree(keys, depth), known[mine], n[mine], [5, 9])
        assert np.allclose(flat, (n[mine] + 1) / (n[mine].sum() + mine.sum() + (1 << depth)), rtol=1e-4)


def test_a_neighbour_raises_the_share_of_a_word_in_its_class():
    """Before, words of one ending had the same share after every word."""
    rng = random.Random(5)
    pairs = [(b"red", b"running"), (b"blue", b"jumping"), (b"green", b"talking"), (b"black", b"sinking")]
    words = [w for _ in range(2000) for w in rng.choice(pairs)]
    keys = _keys(words)
    starts = np.array([0])
    tree = _tree(keys, 4)
    first = tree
    for _ in range(lm.ROUNDS):
        tree = tree.stepped(*tree.slopes(keys, lm.before(keys, starts)))
    back = lm.before(keys, starts)
    assert tree.log10(keys, back).sum() > first.log10(keys, back).sum() + 0.05 * len(keys)
    ends, n = _keys([b for _, b in pairs]), np.array([sum(w == b for w in words) for _, b in pairs])
    assert len(set((ends & np.uint64(15)).tolist())) == 1
    for i, (a, _) in enumerate(pairs):
        share = _within(tree, ends, n, [_keys([a])[0], ends[0]])
        assert share.argmax() == i and share[i] > 0.5


def test_depth_and_table_grow_with_the_distinct_tokens():
    assert [lm.tree_depth(n) for n in (0, 32, 33, 2048, 10**6, 10**9)] == [0, 0, 1, 6, lm.DEEPEST, lm.DEEPEST]
