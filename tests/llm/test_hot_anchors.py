"""A passage shared by many documents, whose anchors have a different context in each."""

import random

from tidemark.llm import substrings


def test_hot_anchors_reach_no_suffix_array(spark, make, monkeypatch):
    r = random.Random(7)

    def words(n):
        return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(n))

    passage = words(80)
    rows = [(i, words(r.randint(5, 30)) + " " + passage + " " + words(r.randint(5, 30))) for i in range(60)]
    rows += [(100 + i, rows[i][1][:150] + words(30)) for i in range(10)] + rows[:3]
    plain = sorted(map(tuple, substrings.substring_dedup(spark, make(rows)).collect()))
    met = []
    divided = substrings.divided

    def seen(spark, asked):
        cold, hot = divided(spark, asked)
        met.append((max(x["count"] for x in cold.groupBy("hash").count().collect()), hot.count()))
        return cold, hot

    monkeypatch.setattr(substrings, "HOT", 5)
    monkeypatch.setattr(substrings, "divided", seen)
    seen_rows, want = set(), {}
    for i, text in sorted(set(rows)):
        raw = text.encode()
        covered = set()
        for k in range(len(raw) - 99):
            if raw[k:k + 100] in seen_rows:
                covered.update(range(k, k + 100))
            seen_rows.add(raw[k:k + 100])
        want[i] = len(covered)
    got = sorted(map(tuple, substrings.substring_dedup(spark, make(rows)).collect()))
    assert got == plain and all(x[2] == want[x[0]] for x in got) and sum(want.values()) > 1000
    assert met[0][0] <= 5 and met[0][1] > 50
