"""Counts that order the members of crowded sets."""

import random

import numpy as np

from tidemark.llm import jaccard


def test_counts_of_members_take_fixed_room(spark):
    r = random.Random(4)
    sets = [np.unique(np.array([r.getrandbits(64) for _ in range(3000)] + list(range(50)), np.uint64)) for _ in range(40)]
    frame = spark.createDataFrame([(i, s.tobytes()) for i, s in enumerate(sets)], "fp long, members binary").repartition(4)
    counts = jaccard.slot_counts(spark, frame)
    slots = np.concatenate(sets) >> np.uint64(64 - jaccard.SLOTS_LOG2)
    assert (counts == np.bincount(slots.astype(np.int64), minlength=1 << jaccard.SLOTS_LOG2)).all()
