"""Secrets: fixed patterns by a plain reading, guess costs by all chains."""

import hashlib
import itertools
import math
import random
import re

import pytest

from tidemark.llm import secrets

WORDS = {"sum": 4.0, "summer": 9.0, "password": 7.0, "merlin": 12.0, "ass": 11.5}
ASSIGN = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def plain_base(text):
    spans = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text) if len(m.group(1)) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return ",".join(f"{secrets.BASE[k]}:{a}:{b}" for a, k, b in sorted(spans))


def all_chains(guess, value):
    """Least bits over every way to cut a value and to read each part, part by part."""
    segments = guess.segments(value, True)

    def readings(i, j):
        yield guess.span + sum(map(guess.character, value[i:j]))
        yield from (bits for start, bits, _ in segments.get(j, ()) if start == i)
        keys = value.lower().translate(secrets.SHIFTED)[i:j]
        ways = [secrets.step(a, b) for a, b in itertools.pairwise(keys)]
        if len(ways) >= 2 and None not in ways:
            yield guess.start + 1 + sum(1 + (0 if a == b else guess.turn) for a, b in itertools.pairwise(ways))

    best = math.inf
    for cuts in itertools.product((0, 1), repeat=len(value) - 1):
        at = [0, *[k + 1 for k, c in enumerate(cuts) if c], len(value)]
        best = min(best, sum(guess.part + min(readings(i, j)) for i, j in itertools.pairwise(at)))
    return best


def test_least_cost_of_all_chains():
    guess, r = secrets.GuessCost(WORDS), random.Random(4)
    values = ["summer2024", "Summer!99", "P@ssw0rd", "qwerty12", "abcabcabc", "aaaaaaaaa", "1qaz2wsx", "01.02.1999", "xK9#mPq", "SuMmEr", "zxsumzx", "é漢ab"]
    values += ["".join(r.choice(["sum", "a", "q", "w", "e", "1", "2", "3", "ab", "!", "@"]) for _ in range(r.randint(1, 5)))[:10] for _ in range(60)]
    for value in values:
        bits, parts = guess(value)
        assert math.isclose(bits, all_chains(guess, value)), value
        assert "".join(p.partition(":")[2] for p in parts.split(" ")) == value


def test_weak_values_cost_less_than_random_ones():
    guess = secrets.GuessCost(WORDS | {w: 7.0 for w in secrets.COMMON})
    for weak in ("password", "Password1", "changeme", "qwertyuiop", "12345678", "aaaaaaaaaaaa", "2024-01-31", "abcabcabcabc"):
        assert guess(weak)[0] < 32 < guess("x9#kPq2$vLw")[0], weak
    assert guess("a" * 20_000)[0] < 32  # a long value is read whole
    assert guess("qwerty")[1] == "walk:qwerty" and guess("Summer2024")[1] == "word:Summer date:2024"


@pytest.fixture(scope="module")
def rows():
    key = "0123456789abcdef01234567"
    return [(1, None), (2, ""), (3, "password: required"), (4, f"token={key} x"), (4, f"token={key} x"), (5, "AKIA" + "A1" * 9 + " AKIA12"),
            (6, "pwd = 'x9#kPq2$vLw' and db://me:Zk3!vv9Qpa@host, Bearer qqqqqqqqqqqq"), (7, "toKen : abc123"), (8, "secret: token:abcdefgh"),
            (9, "é漢😀 api_key='Qw7-zz.12'"), (10, "ſecret=abcdefgh toKen=abcdefgh"), (11, "lorem ipsum " * 20_000 + "passwd=u8Jw2kqQ"),
            (12, "f" * 23 + " " + "f" * 24 + "F"), (None, "secret=abcdef")]


def test_findings(spark, make, rows):
    docs = make(rows)
    words = secrets.learn_words(spark, docs)
    assert words["lorem"] == words["ipsum"] < 1.1 and "abcdef" not in words and "vlw" not in words
    got = secrets.find_secrets(spark, docs, words).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((i is None, i or 0) for i, _ in rows)
    texts = dict(rows)
    for r in got:
        text = texts[r.doc_id] or ""
        base = [f for f in r.findings if f.kind != "guess"]
        assert ",".join(f"{f.kind}:{f.start}:{f.end}" for f in base) == plain_base(text)
        assert all(f.bits > 0 for f in r.findings)
        guesses = {text[f.start:f.end] for f in r.findings if f.kind == "guess"}
        assert guesses == {6: {"x9#kPq2$vLw", "Zk3!vv9Qpa"}, 8: {"token:abcdefgh"}}.get(r.doc_id, set())
    assert secrets.find_secrets(spark, make([]), words).count() == 0 and secrets.learn_words(spark, make([])).keys() == set(secrets.COMMON)


def test_query(spark):
    root = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{root}/documents.parquet").collect()}
    got = secrets.op11_secret_scan(spark, root).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts) and sum(r.n_assign for r in got) > 5 < sum(r.n_hex for r in got)
    for r in got:
        base = plain_base(texts[r.doc_id] or "")
        kinds = [s.split(":")[0] for s in base.split(",")]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(kinds.count(k) for k in secrets.BASE)
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest() and (r.spans == base or r.n_guess)
