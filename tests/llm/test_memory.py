"""What one call of a task's inner step allocates, as many run at once in an executor."""

import pickle
import random
import tracemalloc

import numpy as np

from tidemark.llm import mixing, substrings


def peak_mb(call):
    tracemalloc.start()
    try:
        call()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_a_shard_of_suffixes_is_small():
    r = random.Random(1)
    words = ["".join(r.choice("abcdefgh") for _ in range(8)) for _ in range(3000)]
    contexts = [" ".join(r.choice(words) for _ in range(17)).encode()[:150] for _ in range(substrings.SHARD_BYTES // 150)]
    assert peak_mb(lambda: substrings.shard_runs(contexts, np.arange(len(contexts)), np.zeros(len(contexts), np.int64))) < 110


def test_a_block_of_keys_is_small():
    text = b"some words of a text " * (mixing.BLOCK // 21)
    assert peak_mb(lambda: mixing.strings([text])) < 70


def test_the_fixed_model_scores_as_its_counts_say():
    rng = np.random.default_rng(2)
    keys, _ = mixing.strings([bytes(rng.choice(list(b"abc d"), 4000).tolist())])
    tables = np.zeros(mixing.ORDERS << (mixing.SLOTS_LOG2 + 1), np.float32)
    slots, node, bit = mixing.decisions(keys)
    for k in range(mixing.ORDERS):
        np.add.at(tables, ((k << mixing.SLOTS_LOG2) + slots[k].ravel()) * 2 + bit.ravel(), 1)
    model = mixing.Mixer(tables)
    fresh, _ = mixing.strings([b"abcd dcba xyz ab"])
    slots, node, bit = mixing.decisions(fresh)
    for at in range(len(fresh)):
        total = 0.0
        for j in range(8):
            mixed, gate, counts = 0.0, 0, []
            for k in range(mixing.ORDERS):
                zero, one = map(float, model.tables[k, slots[k, at, j]])
                counts.append((zero, one))
                if zero + one:
                    gate = (k * 16 + min(int(np.log2(zero + one + 1)), 15)) * 8 + j
            gate = gate or j
            for k, (zero, one) in enumerate(counts):
                mixed += model.weights[gate, k] * (np.log((one + mixing.PRIOR) / (zero + mixing.PRIOR)) if zero + one else 0)
            mixed = min(max(mixed, -12), 12)
            p = 1 / (1 + np.exp(-mixed))
            low, part = mixing.place(np.array([mixed]))
            grid = [1 / (1 + np.exp(12 - (low[0] + s) * (24 / mixing.BUCKETS))) for s in (0, 1)]
            p = (p + (1 - part[0]) * grid[0] + part[0] * grid[1]) / 2  # without learning, the map is its grid
            total += np.log10(p if bit[at, j] else 1 - p)
        assert abs(model.fixed().log10(fresh[at:at + 1])[0] - total) < 1e-9


def test_a_sent_scorer_is_read_without_copies():
    rng = np.random.default_rng(3)
    model = mixing.Mixer(rng.integers(0, 5, mixing.ORDERS << (mixing.SLOTS_LOG2 + 1)).astype(np.float32)).fixed()
    raw = pickle.dumps(model, 5)
    assert peak_mb(lambda: pickle.loads(raw)) < 1.3 * (model.stretched.nbytes + model.gates.nbytes) / 1e6
    keys, _ = mixing.strings([b"some words"])
    assert (pickle.loads(raw).log10(keys) == model.log10(keys)).all()
