import random

import pytest

from tidemark.llm.common import documents


@pytest.fixture(scope="module")
def make(spark):
    """Documents with columns whose names the operators use inside, and a null one."""
    def docs(rows):
        return spark.createDataFrame([(i, t, "en", None, len(t or ""), "x", 1, 2.0, True) for i, t in rows],
                                     "doc_id long, text string, lang string, source string, n_chars long, node string, key int, score double, kept boolean")
    return docs


@pytest.fixture(scope="module")
def sample(spark):
    """The smallest given table, whole."""
    return [(r.doc_id, r.text) for r in documents(spark, "/root/testdata/sf0.001").collect()]


@pytest.fixture(scope="module")
def varied():
    """Null, empty and short texts, runs, ties, and near copies of several sizes, in mixed order."""
    r = random.Random(3)
    words = ["".join(r.choice("abcdeéß") for _ in range(r.randint(2, 7))) for _ in range(120)]
    rows = [(0, None), (1, ""), (2, " \n"), (3, "x"), (4, "X"), (5, "a b c"), (6, "A b  c"), (7, "y" * 350), (8, "y" * 99), (9, "ab" * 200)]
    passages = [" ".join(r.choice(words) for _ in range(45)) for _ in range(4)]
    for base in range(40):
        text = [r.choice(words) for _ in range(r.choice([4, 6, 7, 9, 12, 18, 25, 60, 150]))]
        tail = "\n" + r.choice(passages)[r.randint(0, 40):] if r.random() < 0.4 else ""
        for _ in range(16 if base < 3 else r.choice([1, 2, 3])):
            copy = list(text)
            for _ in range(r.choice([0, 0, 1, 1, 2])):
                copy[r.randrange(len(copy))] = r.choice(words)
            rows.append((len(rows), " ".join(copy) + tail))
    r.shuffle(rows)
    return rows


def joined(parent, a, b):
    """Union by smaller name."""
    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    if a is not None:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return root
