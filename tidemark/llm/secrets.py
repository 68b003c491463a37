"""Secrets in texts: fixed patterns, and values in a credential context that are costly to guess.

What stands after ``password:`` may be a word of the prose or a secret. The cost of guessing it
is that of its cheapest reading as a chain of words, dates, repeats, keyboard walks and
brute-force spans, in bits, found by dynamic programming over the places of the value.
"""

from __future__ import annotations

import functools
import math
import re
from bisect import bisect
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, staged, text_or_empty

# The patterns of the base kinds, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of fewer matches nothing, as no other run starts inside it
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "guess")

# Where a credential is named, and where its value stands: quoted, or up to white space.
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)|pwd|secret|token|credentials?|(?:api|access|auth|private)[_-]?key)[A-Za-z0-9_-]{0,24}"""
    r"""["']?[ \t]*(?::=|=>|[:=])[ \t]*(?:"([^"\n]{8,})"|'([^'\n]{8,})'|([^\s"'<>,;]{8,}))"""
    r"""|\bbearer[ \t]+([A-Za-z0-9._~+/=-]{8,})|://[^\s:/@]+:([^\s/@]{8,})@""", re.I | re.A)

NAMES = ("passw", "passp", "passc", "pwd", "secret", "token", "credential", "key", "bearer", "://")

# Strings that stand for a password or are tried first.
COMMON = """password passwd secret token example changeme change default dummy placeholder sample test testing admin root user
guest login welcome letmein master access private public null none undefined required optional invalid redacted hidden
your yours here insert value string enter type hunter dragon monkey football baseball princess sunshine shadow iloveyou
trustno1 abc123 starwars superman batman""".split()
# The rows of a keyboard, each shifted by about half a key, and the shifted digits.
ROWS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
SHIFTED = str.maketrans("!@#$%^&*()_+", "1234567890-=")
# Signs that stand for letters.
LEET = str.maketrans("@4301!$57", "aaeoiisst")
DATE = re.compile(r"(?:19|20)\d\d([-./_]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-./_]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d"
                  r"|(?:0[1-9]|1[0-2])([-./_]?)(?:0[1-9]|[12]\d|3[01])\3(?:19|20)\d\d")
YEAR = re.compile(r"(?:19|20)\d\d")
WORD = re.compile(r"[^\W\d_]{3,24}")
LONGEST = 24
PERIOD = 16
FINDINGS = "array<struct<kind:string,start:int,end:int,bits:double,parts:string>>"


def _places() -> dict[str, tuple[int, int]]:
    return {c: (2 * x + y, y) for y, row in enumerate(ROWS) for x, c in enumerate(row)}


PLACES = _places()


def step(a: str, b: str) -> tuple[int, int] | None:
    """Direction between two neighbouring keys, in half keys and rows; none if they aren't neighbours."""
    p, q = PLACES.get(a), PLACES.get(b)
    if p is None or q is None:
        return None
    d = q[0] - p[0], q[1] - p[1]
    return d if (d[1] == 0 and abs(d[0]) == 2) or (abs(d[1]) == 1 and abs(d[0]) == 1) else None


@dataclass
class GuessCost:
    """Bits it takes to guess a value. ``words`` maps lower-case words to bits.

    Segments and their bits: a word, its own bits, one more for a leading capital or all
    capitals, the choice of places for other capitals, two for signs in place of letters;
    a date, ``date`` bits, or a year, ``year`` bits; a repeat, the cost of its first copy plus
    log2 of the copies, where a repeat has a period of at most ``PERIOD`` and takes as many
    whole copies as follow (a copy is read without repeats of its own); a keyboard walk of three or more neighbouring keys, ``start``
    bits, ``turn`` for each change of direction and one bit for each step; a brute-force span,
    ``span`` bits once and log2 of its class for each character. Every segment takes the
    ``part`` bits of choosing its kind. The least sum over all chains wins.
    """

    words: dict[str, float]
    date: float = 17.0
    year: float = 7.0
    start: float = 6.5
    turn: float = 2.6
    span: float = 1.0
    part: float = 2.3
    memo: dict[str, tuple[float, str]] = field(default_factory=dict)

    def __getstate__(self):
        return self.__dict__ | {"memo": {}}

    def character(self, c: str) -> float:
        if c.isascii():
            return math.log2(10 if c.isdigit() else 26 if c.isalpha() else 33)
        return math.log2(100)

    def word(self, value: str, plain: str, leet: str, i: int, j: int) -> float | None:
        """Bits of ``value[i:j]`` as a word."""
        bits, signs = self.words.get(plain[i:j]), 0.0
        if bits is None:
            if leet[i:j] == plain[i:j]:
                return None
            bits, signs = self.words.get(leet[i:j]), 2.0
            if bits is None:
                return None
        upper = sum(c.isupper() for c in value[i:j])
        if upper == 0:
            return bits + signs
        if upper == j - i or (upper == 1 and value[i].isupper()):
            return bits + signs + 1
        return bits + signs + math.log2(math.comb(j - i, upper)) + 1

    def segments(self, value: str, repeats: bool) -> dict[int, list[tuple[int, float, str]]]:
        """Words, dates and repeats by their end: (start, bits, kind)."""
        plain = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
        leet = plain.translate(LEET)
        out: dict[int, list[tuple[int, float, str]]] = {}
        n = len(value)
        for i in range(n):
            for j in range(i + 3, min(n, i + LONGEST) + 1):
                bits = self.word(value, plain, leet, i, j)
                if bits is not None:
                    out.setdefault(j, []).append((i, bits, "word"))
            for pattern, bits in ((DATE, self.date), (YEAR, self.year)):
                found = pattern.match(value, i)
                if found:
                    out.setdefault(found.end(), []).append((i, bits, "date"))
        copy_bits: dict[str, float] = {}
        for period in range(1, min(PERIOD, n // 2) + 1) if repeats else ():
            stop = n
            for i in range(n - period - 1, -1, -1):  # stop: how far the period holds from i on
                if value[i] != value[i + period]:
                    stop = i + period
                copies = (stop - i) // period
                if copies >= 2:
                    copy = value[i:i + period]
                    if copy not in copy_bits:
                        copy_bits[copy] = self.least(copy, False)[0]
                    out.setdefault(i + copies * period, []).append((i, copy_bits[copy] + math.log2(copies), "repeat"))
        return out

    def least(self, value: str, repeats: bool = True) -> tuple[float, str]:
        """Bits of the cheapest chain, and the chain as ``kind:text`` parts. Ties: the chain found first, by kind and start."""
        segments = self.segments(value, repeats)
        keys = value.lower().translate(SHIFTED) if len(value.lower()) == len(value) else value
        far = math.inf
        best: list[tuple[float, int, str]] = [(0.0, 0, "")]
        span = (far, 0)  # an open brute-force span: bits, start
        pair = walk = (far, 0)  # an open walk of two keys, of three or more
        before = None
        for j in range(1, len(value) + 1):
            bits = self.character(value[j - 1])
            span = min((best[j - 1][0] + self.part + self.span + bits, j - 1), (span[0] + bits, span[1]))
            way = step(keys[j - 2], keys[j - 1]) if j > 1 else None
            if way is None:
                pair = walk = (far, 0)
            else:
                more = 1.0 + (0.0 if way == before else self.turn)
                walk = min((walk[0] + more, walk[1]), (pair[0] + more, pair[1]))
                pair = (best[j - 2][0] + self.part + self.start + 1.0, j - 2)
            before = way
            ways = [(best[i][0] + self.part + b, i, kind) for i, b, kind in segments.get(j, ())]
            best.append(min([*ways, (*span, "brute"), (*walk, "walk")], key=lambda x: x[0]))
        parts, j = [], len(value)
        while j:
            _, i, kind = best[j]
            parts.append(f"{kind}:{value[i:j]}")
            j = i
        return best[-1][0], " ".join(reversed(parts))

    def __call__(self, value: str) -> tuple[float, str]:
        found = self.memo.get(value)
        if found is None:
            found = self.least(value)
            if len(value) <= 256:
                if len(self.memo) >= 100_000:
                    self.memo.clear()
                self.memo[value] = found
        return found


def names_any(text: str) -> bool:
    """Whether a text holds a part of what names a credential in either pattern: a plain search spares most texts the slower ones."""
    low = text.lower()
    return any(part in low for part in NAMES)


def base_spans(text: str) -> list[tuple[int, str, int, int, int]]:
    """(start, kind, end, start and end of the value) of the fixed patterns."""
    out = [(m.start(), "assign", m.end(), m.start(2), m.end(2)) for m in (ASSIGN.finditer(text) if names_any(text) else ())
           if m.end(2) - m.start(2) >= 6]
    out += [(m.start(), "access", m.end(), m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return out + [(m.start(), "hex", m.end(), m.start(), m.end()) for m in HEX.finditer(text)]


def context_values(text: str):
    """(start, end) of what stands as the value of a credential."""
    for m in CONTEXT.finditer(text) if names_any(text) else ():
        yield m.span(m.lastindex)


def without_values(text: str) -> str:
    """The text with the values of credentials blanked, so that no secret is learned as a word."""
    parts, at = [], 0
    for start, end in sorted([(s[3], s[4]) for s in base_spans(text)] + list(context_values(text))):
        if start > at:
            parts.append(text[at:start])
        at = max(at, end)
    return " ".join([*parts, text[at:]])


def learn_words(spark: SparkSession, docs: DataFrame, share: float = 1e-5) -> dict[str, float]:
    """Bits of the words of all texts: log2 of one over their share.

    Words of 3 to 24 letters, in lower case, of whole texts but for the values of credentials.
    Those with a share of at least ``share`` are kept, 1 / ``share`` at most, whatever the
    size of the corpus; counts are summed before they are shuffled. The fixed list of common
    strings takes seven bits a word, or fewer if the corpus says so.
    """
    def run(batches):
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts.update(WORD.findall(without_values(text).lower()))
                if len(counts) > 200_000:
                    yield from counted(counts)
                    counts.clear()
        yield from counted(counts)

    def counted(counts):
        if counts:
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    counts = docs.select(text_or_empty().alias("text")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = staged(spark, counts, "words")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    words = {r.word: math.log2(total / r.n) for r in counts.filter(F.col("n") >= share * total).toLocalIterator()}
    return words | {w: min(7.0, words.get(w, 7.0)) for w in COMMON}


def find_secrets(spark: SparkSession, docs: DataFrame, words: dict[str, float], threshold: float = 32.0) -> DataFrame:
    """doc_id and the findings of every row: kind, start, end (code points, end exclusive), bits to guess, cheapest chain.

    Findings of the fixed patterns are all kept, whatever their bits. A value in a credential
    context that no such finding covers is a ``guess`` if it takes ``threshold`` bits or more.
    They come by start, then kind as in KINDS. Null text counts as empty. Rows are independent
    of each other; a repeated row gives a repeated result, an empty table an empty one.
    """
    cost = spark.sparkContext.broadcast(GuessCost(words))

    def run(batches):
        guess = cost.value
        for batch in batches:
            found = [[dict(zip(("kind", "start", "end", "bits", "parts"), f, strict=True)) for f in findings(guess, text, threshold)]
                     for text in batch.column("text").to_pylist()]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("bits", pa.float64()), ("parts", pa.string())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], names=["doc_id", "findings"])

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(run, f"doc_id long, findings {FINDINGS}")


def findings(guess: GuessCost, text: str, threshold: float) -> list[tuple[str, int, int, float, str]]:
    base = base_spans(text)
    out = [(start, kind, end, *guess(text[a:b])) for start, kind, end, a, b in base]
    ends = [[(s[0], s[2]) for s in base if s[1] == kind] for kind in BASE]  # apart and in order within a kind
    for start, end in context_values(text):
        before = [spans[at - 1] for spans in ends if (at := bisect(spans, start, key=lambda x: x[0]))]
        if any(end <= stop for _, stop in before):
            continue
        bits, parts = guess(text[start:end])
        if bits >= threshold:
            out.append((start, "guess", end, bits, parts))
    out.sort(key=lambda s: (s[0], KINDS.index(s[1])))
    return [(kind, start, end, bits, parts) for start, kind, end, bits, parts in out]


def op11_secret_scan(spark: SparkSession, root: str) -> DataFrame:
    docs = documents(spark, root)
    found = find_secrets(spark, docs, learn_words(spark, docs))

    def of(kinds):
        return F.filter("findings", lambda f: f["kind"].isin(*kinds))

    def count(kind):
        return F.size(of([kind])).cast("long").alias(f"n_{kind}")

    def shown(spans):
        return F.array_join(F.transform(spans, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")

    return found.select("doc_id", *map(count, BASE), F.sha2(shown(of(BASE)), 256).alias("base_sha256"),
                        shown(F.col("findings")).alias("spans"), count("guess"))
