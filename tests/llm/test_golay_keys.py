"""The Golay keys of the near-duplicate stage: soft decoding, what shares a key, what leaves it."""

import numpy as np
import pytest

from tidemark.llm import golay
from tidemark.llm import near_copies as N


def test_nearest_codewords_equal_a_search_through_all():
    words = np.array([w for w in range(1 << 11)]) << 11
    words = np.concatenate([words, words + (1 << 22)])
    words ^= golay._syndrome(words)
    assert (golay.index(words) == np.arange(4096)).all()
    signs = (words[:, None] >> np.arange(23) & 1) * 2 - 1
    values = np.random.default_rng(1).standard_normal((200, 23)).astype(np.float32)
    found, score = golay.nearest(values, 8)
    wanted = values @ signs.T.astype(np.float32)
    assert (found == np.argsort(-wanted, axis=1)[:, :8]).all()
    assert np.allclose(score, np.take_along_axis(wanted, found, 1), atol=1e-4)
    # signs alone: the nearest is what the word decodes to
    hard = np.random.default_rng(2).integers(0, 1 << 23, 200)
    assert (golay.nearest((hard[:, None] >> np.arange(23) & 1) * 2 - 1, 1)[0][:, 0] == golay.index(hard)).all()


def test_first_bits_are_the_simhash_of_the_shingles():
    from tidemark.llm.simhash import simhash

    text = b" ".join(b"w%d" % i for i in range(700))
    bits = N.bit_counts(N.shingle_set(text))[:64] > 0
    assert sum(1 << i for i in np.flatnonzero(bits).tolist()) == simhash(text, 5)


@pytest.mark.parametrize("first, second, common", [(4, 5, 4), (9, 9, 8), (18, 18, 16), (270, 270, 240), (240, 300, 240)])
def test_pairs_at_the_threshold_share_a_key_and_unlike_ones_do_not(first, second, common):
    rng, n = np.random.default_rng(first), 500
    draw = lambda size: rng.integers(0, 1 << 64, (n, size), dtype=np.uint64)
    shared, one, two = draw(common), draw(first - common), draw(second - common)
    a, b = (np.stack([N.bit_counts(np.concatenate(x)) for x in zip(shared, more)]) for more in (one, two))
    keys = [[set(k) for k in N.golay_keys(x).tolist()] for x in (a, b)]
    assert all(len(k) == N.TABLES * N.PROBES for k in keys[0])
    assert all(x & y for x, y in zip(*keys))
    apart = (a > 0) != (b > 0)
    assert apart[:, :128].sum(axis=1).max() <= N.FAR
    assert apart.sum(axis=1).max() <= (N.FAR_FEW if first < N.FEW else N.FAR_ALL)
    assert sum(bool(x & y) for x, y in zip(keys[0], keys[1][1:])) <= 5


def test_nodes_that_meet_nobody_leave_and_equal_bands_are_one(spark):
    base = ["w%d" % i for i in range(300)]
    copy = base[:150] + ["other"] + base[151:]
    half = base[:200] + ["x%d" % i for i in range(100)]
    alone = ["y%d" % i for i in range(300)]
    docs = spark.createDataFrame([(n, " ".join(t)) for n, t in enumerate([base, copy, half, alone, base])], "doc_id int, text string")
    rows = N._signatures(docs.repartition(2), "doc_id", "text")
    owner = {r.doc_id: r.node for r in rows.select(rows.id.alias("doc_id"), "node").collect()}
    assert owner[0] == owner[4] and len(set(owner.values())) == 4
    bands = N._bands(rows.dropDuplicates(["node"]), N.SIMILARITY).collect()
    assert {r.node for r in bands} == {owner[0], owner[1]}
    assert len({r.band for r in bands}) == 1 and {r.members for r in bands} == {2}
