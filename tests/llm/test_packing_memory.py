"""What a worker remembers stays bounded, and what it forgets is looked up again."""

import numpy as np

from commentlens.llm import packing


def test_remembered_ids_stay_within_their_bound():
    asked = []

    def learn(keys):
        asked.extend(keys)
        lengths = np.array([len(k) % 3 for k in keys], np.int64)
        return np.concatenate([np.full(n, int(k), np.uint32) for k, n in zip(keys, lengths)]), lengths

    ids = packing._Ids(10, learn)
    rng = np.random.default_rng(1)
    for _ in range(60):
        keys = [b"7", b"11", *(b"%d" % n for n in rng.integers(0, 500, 15))]
        found, lengths = ids.get(keys)
        assert found.tolist() == [int(k) for k in keys for _ in range(len(k) % 3)]
        assert lengths.tolist() == [len(k) % 3 for k in keys]
        assert len(ids.known) <= 10 and ids.used <= 20
    afresh = 1 + sum(1 for k in asked if k == b"7")
    assert afresh > 2 and len(asked) > 10 * packing.AFRESH  # new texts get their turn
