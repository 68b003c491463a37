"""Best-fit packing of token pieces into sequences, with a bounded number of open bins."""

from __future__ import annotations

import base64
import functools
import json
import re
import struct
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, staged, text_or_empty

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"


class RunEncoder:
    """Token ids of whole texts, with the runs between single spaces remembered.

    ``path`` names a rank file that holds the vocabulary of ``byte_bpe_50k.json``; its ids are
    those of the ``tokenizers`` library (tested), found several times as fast. A single space
    between two other characters always starts a match of the pattern, so such runs can be
    encoded apart; any other text is encoded whole. Added tokens, named by the JSON file beside
    the rank file, are found in the text first, as that library does.
    """

    def __init__(self, path: str, size: int = 600_000):
        import tiktoken
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.ids = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                     special_tokens={}).encode_ordinary
        added = json.loads(Path(path).with_suffix(".json").read_text(encoding="utf-8")).get("added_tokens") or []
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("added tokens that depend on their surroundings are not supported")
        self.added = {t["content"]: struct.pack("<I", t["id"]) for t in added}
        self.marks = re.compile("|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) or r"(?!)")
        self.size = size
        self.known: dict[str, bytes] = {}

    def __call__(self, text: str) -> bytes:
        return np.array(self.ids(text), "<u4").tobytes()

    def run(self, run: str) -> bytes | None:
        """Ids of a run after one space; none if white space at its rim ties it to its surroundings."""
        if not run or run[0].isspace() or run[-1].isspace():
            return None
        if len(self.known) >= self.size:
            self.known.clear()
        ids = self.ids(" " + run)
        code = struct.pack(f"<{len(ids)}I", *ids)
        if len(run) <= 64:
            self.known[run] = code
        return code

    def encode(self, text: str) -> bytes:
        codes, at = [], 0
        for mark in self.marks.finditer(text):
            codes += self.between(text[at:mark.start()]), self.added[mark.group()]
            at = mark.end()
        return b"".join(codes) + self.between(text[at:]) if at else self.between(text)

    def between(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        first, *runs = text.split(" ")
        if (not first and runs) or first[-1:].isspace():
            return self(text)
        known = self.known.get
        codes = [known(r) or self.run(r) for r in runs]
        return self(text) if None in codes else self(first) + b"".join(codes)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> RunEncoder:
    return RunEncoder(path)


def cut(docs: DataFrame, path: str | None = None, end_id: int = 2, size: int = 1024) -> DataFrame:
    """Pieces of at most ``size`` ids of every document, its ids followed by ``end_id``.

    Only longer documents are cut; the first piece takes what does not fill a whole one.
    Null text counts as empty: one piece that holds ``end_id`` alone.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    last = int(end_id).to_bytes(4, "little")

    def run(batches):
        coder = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows: list[tuple] = []
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    code = coder.encode(text) + last
                    n = len(code) // 4
                    start, piece, length = 0, 0, n % size or size
                    while start < n:
                        rows.append((doc, piece, start, length, zlib.crc32(code[4 * start:4 * (start + length)])))
                        start, piece, length = start + length, piece + 1, size
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(run, PIECES)


def best_fit(lengths: list[int], size: int, open_bins: int) -> tuple[list[int], list[int]]:
    """(bin, offset) of each length, placed one after the other.

    Open bins are kept by free space; a bitset of the spaces in use finds the tightest one
    that fits by its lowest set bit. With ``open_bins`` open, the fullest closes first.
    """
    by_space: list[list[int]] = [[] for _ in range(size + 1)]
    used, n_open, n_bins = 0, 0, 0
    bins, offsets = [], []
    for length in lengths:
        fitting = used >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            at = by_space[space].pop()
            if not by_space[space]:
                used ^= 1 << space
            n_open -= 1
        else:
            at, space, n_bins = n_bins, size, n_bins + 1
        bins.append(at)
        offsets.append(size - space)
        left = space - length
        if left:
            if n_open == open_bins:
                fullest = (used & -used).bit_length() - 1
                by_space[fullest].pop()
                if not by_space[fullest]:
                    used ^= 1 << fullest
                n_open -= 1
            by_space[left].append(at)
            used |= 1 << left
            n_open += 1
    return bins, offsets


def pack(spark: SparkSession, pieces: DataFrame, size: int = 1024, open_bins: int = 512, group: int = 1 << 16) -> DataFrame:
    """Pieces with their sequence_id and offset.

    Pieces of full length make a sequence each and need no packing. The others are dealt by
    hash to groups of about ``group`` pieces, whatever the size of the table, and each group
    is packed in hash order, so that long and short pieces mix; only lengths and ids move,
    no tokens. A group ends with at most ``open_bins`` unfilled sequences. The result depends
    on the staged pieces alone, so a lost task repeats it. Repeated rows are packed as often
    as they occur.
    """
    pieces = staged(spark, pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    n = pieces.filter(F.col("length") < size).count()
    groups = max(1, -(-n // group))
    key = F.xxhash64("doc_id", "piece", "row")  # rows without a doc_id, or that repeat, are dealt evenly too
    dealt = (pieces.filter(F.col("length") < size).withColumn("at", key)
             .repartition(groups, "at").sortWithinPartitions("at", "doc_id", "piece", "start", "length", "ids_crc32").drop("at", "row"))

    def run(batches):
        from pyspark import TaskContext
        tables = list(batches)  # about ``group`` rows of numbers
        if not tables:
            return
        rows = pa.Table.from_batches(tables)
        bins, offsets = best_fit(rows.column("length").to_pylist(), size, open_bins)
        base = TaskContext.get().partitionId() << 32
        out = rows.append_column("sequence_id", pa.array([base + b for b in bins], pa.int64()))
        yield from out.append_column("offset", pa.array(offsets, pa.int64())).to_batches()

    # Full pieces take the negative numbers, one each.
    full = pieces.filter(F.col("length") == size).drop("row").withColumn(
        "sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    return dealt.mapInArrow(run, PACKED).unionByName(full)


def op4_best_fit_packing(spark: SparkSession, root: str) -> DataFrame:
    return pack(spark, cut(documents(spark, root)))
