"""Byte-level BPE by longest matches and backtracking, in linear time.

A token sequence is the BPE encoding of a piece exactly if every two neighbours are the
encoding of their concatenation. So a walk that takes the longest token at a place, goes on
to shorter ones when it does not fit its left neighbour, and steps back when none does, ends
with the encoding. Places that lead nowhere are marked and never tried again.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import struct
from collections.abc import Iterable

import ahocorasick
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import documents, text_or_empty

BATCH_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class ByteBpe:
    """Encoder and decoder for a rank file; matches of ``pattern`` are encoded one by one."""

    def __init__(self, path: str, pattern: str, cache_size: int = 600_000):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.ranks = ranks
        self.words = {i: w for w, i in ranks.items()}
        self.table = [self.words.get(i, b"") for i in range(max(ranks.values()) + 1)]
        self.lengths = [len(w) for w in self.table]
        self.find = regex.compile(pattern).findall
        self.matcher = ahocorasick.Automaton()
        for word, i in ranks.items():
            self.matcher.add_word(word.decode("latin-1"), (i, len(word) - 1))
        self.matcher.make_automaton()
        self.pairs: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.shorter = {i: next((ranks[word[:n]] for n in range(len(word) - 1, 0, -1) if word[:n] in ranks), None)
                        for i, word in self.words.items()}
        for i, word in sorted(self.words.items()):
            self._learn(i, word)
        self.cache_size = cache_size
        self.pieces = _Memo(self._piece_bytes, cache_size // 3)
        self.spaced = _Memo(self._spaced_bytes, cache_size)

    def _learn(self, i: int, word: bytes) -> None:
        """The last merge that makes this token."""
        self.halves[i] = (i, i)
        left = self.shorter[i]
        while left is not None:
            right = self.ranks.get(word[len(self.words[left]):])
            if right is not None and left < i and right < i and self._fit(left, right):
                self.pairs[left, right] = i
                self.halves[i] = (left, right)
                return
            left = self.shorter[left]

    def _fit(self, left: int, right: int) -> bool:
        """Do the two tokens stay apart? Undo the later merge at the seam until one does or none is left."""
        limit = 1 << 62
        while True:
            if self.pairs.get((left, right), limit) < limit:
                return False
            for side in ((0, 1) if left > right else (1, 0)):
                if side == 0:
                    limit, part = left, self.halves[left][1]
                    if part != left:
                        left = part
                        break
                else:
                    limit, part = right + 1, self.halves[right][0]
                    if part != right:
                        right = part
                        break
            else:
                return True

    def piece(self, raw: bytes) -> list[int]:
        """Ids of one piece."""
        if raw in self.ranks:
            return [self.ranks[raw]]
        # Ends ascend: the last token found at a start is the longest one there.
        longest = {end - back: i for end, (i, back) in self.matcher.iter(raw.decode("latin-1"))}
        fits, lengths, shorter = self.fits, self.lengths, self.shorter
        if len(fits) > 2_000_000:
            fits.clear()
        out: list[int] = []
        dead: set[int] = set()
        at, token = 0, longest.get(0)
        while token is not None:
            end = at + lengths[token]
            good = end not in dead
            if good and out:
                pair = (out[-1], token)
                good = fits.get(pair)
                if good is None:
                    good = fits[pair] = self._fit(*pair)
            if good:
                out.append(token)
                at, token = end, longest.get(end)
                continue
            token = shorter[token]
            if token is None:
                dead.add(at)
                token = out.pop()
                at -= lengths[token]
        return out

    def _piece_bytes(self, piece: str) -> bytes:
        ids = self.piece(piece.encode())
        return struct.pack(f"<{len(ids)}I", *ids)

    def _spaced_bytes(self, run: str) -> bytes:
        """Ids of a run that follows one space. Runs with white space at a rim depend on what is around them."""
        if not run or run[0].isspace() or run[-1].isspace():
            raise _Unsafe
        if run.isalpha():  # one match of the pattern
            return self.pieces[" " + run]
        return b"".join(map(self.pieces.__getitem__, self.find(" " + run)))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers.

        A single space between two other characters always starts a match of the pattern, so
        the runs between such spaces are encoded apart and remembered.
        """
        runs = text.split(" ")
        try:
            if runs[0][-1:].isspace() or (len(runs) > 1 and not runs[0]):
                raise _Unsafe
            first = b"".join(map(self.pieces.__getitem__, self.find(runs[0])))
            return first + b"".join(map(self.spaced.__getitem__, runs[1:]))
        except _Unsafe:
            return b"".join(map(self.pieces.__getitem__, self.find(text)))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.table.__getitem__, ids))


class _Unsafe(Exception):
    """This run can't be encoded without its surroundings."""


class _Memo(dict):
    """Remembers results for short keys; starts anew when full."""

    def __init__(self, of, size: int):
        super().__init__()
        self.of, self.size = of, size

    def __missing__(self, key):
        value = self.of(key)
        if len(key) <= 64:
            if len(self) >= self.size:
                self.clear()
            self[key] = value
        return value


@functools.lru_cache(maxsize=2)
def load(path: str, pattern: str) -> ByteBpe:
    """One encoder per worker and file."""
    return ByteBpe(path, pattern)


def bpe_digests(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: whole texts encoded and decoded again.

    Null text counts as empty (no tokens). Rows are independent of each other; a repeated
    row gives a repeated result, an empty table an empty one.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    pattern = pattern or public_tokenizers.PATTERN

    def run(batches):
        codec = load(path, pattern)
        for batch in batches:
            counts, ids_hex, text_hex = [], [], []
            for text in batch.column("text").to_pylist():
                ids = codec.encode(text)
                counts.append(len(ids) // 4)
                ids_hex.append(hashlib.sha256(ids).hexdigest())
                text_hex.append(hashlib.sha256(codec.decode(memoryview(ids).cast("I"))).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(text_hex, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, BATCH_SCHEMA)


def op5_byte_bpe(spark: SparkSession, root: str) -> DataFrame:
    return bpe_digests(documents(spark, root))
