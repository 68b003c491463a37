"""Exact, line, n-gram, substring and vector deduplication against brute force."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest

from tests.llm.conftest import joined
from tidemark.llm import common, exact_dedup, jaccard, lines, substrings, suffixes, vectors

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def similar_components(sets, percent):
    parent, links, holders = {k: k for k in sets}, 0, defaultdict(list)
    root = joined(parent, None, None)
    for k, members in sets.items():
        both = defaultdict(int)
        for m in members:
            for other in holders[m]:
                both[other] += 1
            holders[m].append(k)
        for other, n in both.items():
            if 100 * n >= percent * (len(members) + len(sets[other]) - n):
                joined(parent, k, other)
                links += 1
    return {k: root(k) for k in sets}, links


def word_sets(rows, width):
    out = {}
    for i, text in rows:
        w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
        out[i] = frozenset(tuple(w[k:k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])
    return out


@pytest.mark.parametrize("width, percent", [(4, 85), (5, 80)])
def test_ngram_join(spark, make, varied, width, percent):
    rows = varied + varied[:3]  # repeated rows
    sets = word_sets(rows, width)
    want, links = similar_components(sets, percent)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_groups(spark, make(rows), width, percent).collect()]
    assert links > 50 and len(got) == len(rows)
    assert all(n == len(sets[i]) and c == want[i] for i, n, c in got)


def test_shared_keys_survive_batch_borders():
    import pyarrow as pa
    rng = np.random.default_rng(1)
    for _ in range(60):
        rows = sorted(zip(rng.integers(0, 12, 40).tolist(), rng.integers(0, 3, 40).tolist()))
        cuts = sorted(rng.integers(0, 41, 5).tolist())
        parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, 40])]
        batches = [pa.RecordBatch.from_arrays([pa.array([k for k, _ in p], pa.int64()), pa.array([f for _, f in p], pa.int64())], names=["key", "fp"]) for p in parts]
        got = [tuple(r.values()) for b in jaccard.shared_only(batches) for r in b.to_pylist()]
        kinds = sorted(set(rows))
        assert got == [(k, f) for k, f in kinds if sum(k == x for x, _ in kinds) > 1]


def test_exact(spark, make, varied):
    rows = varied + [(900 + i, t) for i, t in varied[:40]]
    got = {r.doc_id: r for r in exact_dedup.exact_groups(spark, make(rows), max_bits=1024).collect()}
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    for i, t in rows:
        own = groups[t or ""]
        assert (got[i].keep_id, got[i].group_size, got[i].kept) == (max(own), len(own), i == max(own))
        assert got[i].text_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert exact_dedup.exact_groups(spark, make([])).count() == 0


def test_exact_is_native(spark, make, varied):
    plan = exact_dedup.exact_groups(spark, make(varied))._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan


def test_lines(spark, make, varied, sample):
    rows = varied + [(1000 + i, t) for i, t in sample]
    places, grams = [], {}
    for i, text in sorted(rows):
        for k, line in enumerate((text or "").split("\n")):
            norm = line.strip(" \t\r\x0b\x0c").lower()
            if norm:
                places.append((i, k, norm))
                grams[norm] = {norm[j:j + 5] for j in range(max(1, len(norm) - 4))}
    want, _ = similar_components(grams, 80)
    first, gone = {}, set()
    for i, k, norm in places:
        if first.setdefault(want[norm], (i, k)) != (i, k):
            gone.add((i, k))
    got = {r.doc_id: r for r in lines.dedup_lines(spark, make(rows)).collect()}
    found = {(i, k) for i, r in got.items() for k in r.removed}
    assert found <= gone | {(i, k) for i, k, n in places if (i, k) not in gone and (i, k) in found}
    assert len(found & gone) >= 0.99 * len(gone) and len(found - gone) <= 0.01 * len(gone)
    for i, text in rows:
        left = None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if (i, k) not in found)
        assert got[i].text == left


def test_substrings(spark, make, varied):
    rows = varied + varied[:5]
    seen, want = set(), {}
    for i, text in sorted(set(rows), key=lambda r: r[0]):
        raw = (text or "").encode()
        covered = np.zeros(len(raw) + 1, bool)
        for k in range(len(raw) - 99):
            if raw[k:k + 100] in seen:
                covered[k:k + 100] = True
            seen.add(raw[k:k + 100])
        kept = bytes(b for b, c in zip(raw, covered) if not c)
        want[i] = (len(raw), int(covered[:len(raw)].sum()), int((np.diff(np.append(0, covered.astype(int))) == 1).sum()), hashlib.sha256(kept).hexdigest())
    got = substrings.substring_dedup(spark, make(rows)).collect()
    assert len(got) == len(rows) and sum(w[1] for w in want.values()) > 1000
    assert all(tuple(r)[1:5] == want[r.doc_id] for r in got)
    assert substrings.substring_dedup(spark, make([])).count() == 0


def test_suffix_arrays():
    rng = np.random.default_rng(2)
    for _ in range(400):
        kinds = int(rng.choice([1, 2, 3, 20]))
        s = np.append(np.tile(rng.integers(1, kinds + 1, rng.integers(0, 30)), rng.integers(1, 4)), 0)
        assert suffixes.suffix_array(s, kinds + 1).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())


def test_components(spark):
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (260, 2))] + [(k, k + 1) for k in range(400, 460)]
    parent = {k: k for p in pairs for k in p}
    root = joined(parent, None, None)
    for a, b in pairs:
        joined(parent, a, b)
    got = dict(tuple(r) for r in common.components(spark, spark.createDataFrame(pairs, "a long, b long")).collect())
    assert got == {k: root(k) for a, b in pairs if a != b for k in (a, b)}


def test_vectors(spark):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(60, 16))
    rows = [(i, (centre[i % 60] + rng.normal(size=16) * (0.1 if i % 3 else 0.8)).tolist()) for i in range(600)]
    rows += [(700 + i, rows[5][1]) for i in range(30)]
    odd = [(800, None), (801, []), (802, [0.0] * 16), (803, [1.0, None]), (804, [float("nan")] * 16), (805, [float("inf")] * 16)]
    got = {r.vec_id: r for r in vectors.link_vectors(spark, spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>"), shard=100).collect()}
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    found = np.array([got[i].n_links for i, _ in rows])
    assert (found <= near.sum(1) - 1).all() and found.sum() >= 0.9 * (near.sum() - len(x))
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i, _ in odd)


def test_vectors_hot_group_in_parts(spark, monkeypatch):
    """A third of the rows are near copies: their shards are cut into parts, and no link is counted twice or lost."""
    monkeypatch.setattr(vectors, "SPLIT", 40)
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(size=(200, 16)), rng.normal(size=16) + rng.normal(size=(150, 16)) * 0.05])
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000 + i, x[210].tolist()) for i in range(20)]
    got = {r.vec_id: r for r in vectors.link_vectors(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>"), shard=60).collect()}
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.9).sum(1) - 1
    found = np.array([got[i].n_links for i, _ in rows])
    assert (found <= near).all() and found.sum() >= 0.95 * near.sum()
    assert all(got[i].component_id == 200 for i, _ in rows[200:])


def test_hot_group_shares_a_home():
    """A third of the vectors are different near copies: every two of them meet in a shard."""
    rng = np.random.default_rng(11)
    x = np.concatenate([rng.normal(size=(8000, 64)), rng.normal(size=64) + rng.normal(size=(4000, 64)) * 0.3])
    x = vectors.unit(list(x))
    homes = vectors.homes_of(x, vectors.centres(x[rng.permutation(len(x))[:6000]], 120, 0.9), 3, 0.9)[8000:]
    assert (homes == np.bincount(homes.ravel()).argmax()).any(1).all()


def test_vectors_below_the_target_are_compared_exactly(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SPLIT", 60)
    monkeypatch.setattr(vectors, "audited", lambda links, asked: 0.0)
    rng = np.random.default_rng(12)
    x = rng.normal(size=(12, 16))[rng.integers(0, 12, 300)] + rng.normal(size=(300, 16)) * 0.25
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = {r.vec_id: r.n_links for r in vectors.link_vectors(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>"), shard=40).collect()}
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert [got[i] for i in range(300)] == ((x @ x.T >= 0.9).sum(1) - 1).tolist()


def test_audit_counts_nodes_not_links(spark):
    asked = spark.createDataFrame([(100, 98), (200, 1), (300, 1)], "a long, true long")
    links = spark.createDataFrame([(100, 98)], "a long, n long")
    assert abs(vectors.audited(links, asked) - 1 / 3) < 1e-9


def test_lines_of_one_token_tabs_and_typos(spark, make):
    """Lines without single spaces, and scattered typos, are found wherever they differ."""
    rng = np.random.default_rng(13)
    letters = list("abcdefghijklmnopqrstuvwxyz0123456789")

    def word(n):
        return "".join(rng.choice(letters, n))

    bases = ["https://w" + word(91) for _ in range(40)] + ["\t".join(word(6) for _ in range(15)) for _ in range(40)]
    bases += ["".join(chr(c) for c in rng.integers(0x1780, 0x17B3, 100)) for _ in range(40)] + [" ".join(word(6) for _ in range(15)) for _ in range(40)]
    rows = []
    for k, base in enumerate(bases):
        at = 4 if k % 4 else 50  # an edit among the first characters, or in the middle
        rows += [(2 * k, base), (2 * k + 1, base[:at] + "#" + base[at + 1:])]
    got = {r.doc_id: r.n_removed for r in lines.dedup_lines(spark, make(rows)).collect()}
    assert not any(got[2 * k] for k in range(len(bases)))
    for kind in range(4):
        assert sum(got[2 * k + 1] for k in range(40 * kind, 40 * kind + 40)) >= 39
