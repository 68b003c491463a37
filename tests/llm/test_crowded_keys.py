"""A passage common to many documents that are not similar: their shared keys must not pair them all."""

import random

import numpy as np

from tests.llm.test_groups import similar_components, word_sets
from tidemark.llm import jaccard


def rows():
    r = random.Random(5)

    def words(n):
        return ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n)]

    passage = words(40)
    found = [(i, " ".join(words(10) + passage + words(10))) for i in range(300)]
    for i in range(0, 300, 7):  # near copies, which must still be found
        copy = found[i][1].split()
        copy[3] = words(1)[0]
        found.append((1000 + i, " ".join(copy)))
    found += [(2000 + i, " ".join(passage[:20] + passage[20 + i:])) for i in range(12)]  # little more than the passage
    return found


def test_common_passage_makes_few_pairs(spark, make, monkeypatch):
    compared, rounds = [], jaccard.component_rounds

    def counting(spark, shared, verify, **more):
        def seen(pairs):
            compared.append(pairs.count())
            return verify(pairs)
        return rounds(spark, shared, seen, **more)

    monkeypatch.setattr(jaccard, "component_rounds", counting)
    texts = rows()
    want, links = similar_components(word_sets(texts, 4), 85)
    got = {r.doc_id: r.component_id for r in jaccard.near_groups(spark, make(texts)).collect()}
    assert got == want and links > 40
    assert max(compared) < 10 * len(texts)  # all pairs of the passage's keys are some 45,000


def test_rare_members_first():
    members = np.array([2, 5, 9, 11], np.uint64)
    assert jaccard.ranked(members, np.array([5, 9, 10], np.uint64), np.array([80, 70, 90])).tolist() == [2, 11, 9, 5]
    assert jaccard.ranked(members, np.array([], np.uint64), np.array([])).tolist() == [2, 5, 9, 11]
