"""Alignment of two tokenizers' tokens by the places where tokens of both end.

Each tokenizer gives every token an end, counted in bytes from the start of the text. Where
the same number of tokens lies behind two equal ends, the arrays of ends agree at a constant
index shift for as long as tokens go one to one. Such stretches are jumped by comparing slices
that double in length, then halve up to the first difference. What follows is a group of
several tokens; it is walked token by token up to the next common end, which sets the shift anew.
"""

from __future__ import annotations

import base64
import functools
from array import array

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, staged, text_or_empty
from tidemark.llm.packing import encoder as rank_encoder

ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, groups string, pairs array<long>, times array<int>"
# Id pairs with at least this share of all links are looked up by broadcast: they are at most 1 / share.
HOT_LINKS = 1e-5
SPACE_MARK = "▁"


def same_from(a: bytes, b: bytes, i: int, j: int) -> int:
    """How many entries agree from ``a[i]`` and ``b[j]`` on, both arrays of 4-byte numbers."""
    limit = min(len(a) // 4 - i, len(b) // 4 - j)
    x, y, good, width = 4 * i, 4 * j, 0, 1
    while good + width <= limit and a[x + 4 * good:x + 4 * (good + width)] == b[y + 4 * good:y + 4 * (good + width)]:
        good += width
        width *= 2
    while width > 1:  # fewer than ``width`` entries more agree: halve up to the first difference
        width //= 2
        if good + width <= limit and a[x + 4 * good:x + 4 * (good + width)] == b[y + 4 * good:y + 4 * (good + width)]:
            good += width
    return good


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """Stretches (from_a, from_b, to_a, to_b) of token numbers, both ends excluded, in order.

    A stretch whose first ends agree goes one to one; one whose first ends differ is one group
    of several tokens. The last end of both must be the same.
    """
    raw_a, raw_b = ends_a.astype("<u4").tobytes(), ends_b.astype("<u4").tobytes()
    list_a, list_b = ends_a.tolist(), ends_b.tolist()
    out, i, j, n = array("q"), 0, 0, len(list_a)
    while i < n:
        x, y = i, j
        at, other = list_a[i], list_b[j]
        if at == other:
            more = same_from(raw_a, raw_b, i, j)
            x, y = i + more, j + more
        else:
            while at != other:
                if at < other:
                    x += 1
                    at = list_a[x]
                else:
                    y += 1
                    other = list_b[y]
            x, y = x + 1, y + 1
        out.extend((i, j, x, y))
        i, j = x, y
    return np.frombuffer(out, "q").reshape(-1, 4)


def last_tokens(stretches: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(last token of A, of B, number of the stretch) of every group."""
    i, j, x, y = stretches.T
    single = ends_a[i] == ends_b[j]
    groups = np.where(single, x - i, 1)
    nth = np.arange(groups.sum()) - np.repeat(np.cumsum(groups) - groups, groups)
    return (np.repeat(np.where(single, i, x - 1), groups) + nth, np.repeat(np.where(single, j, y - 1), groups) + nth,
            np.repeat(np.arange(len(i)), groups))


class PairNames(dict):
    """Text ``a|b`` of an id pair."""

    def __missing__(self, pair: int) -> str:
        if len(self) >= 300_000:
            self.clear()
        name = self[pair] = f"{pair >> 32}|{pair & 0xFFFFFFFF}"
        return name


class TwoTokenizers:
    """Ids and byte lengths of ``" " + text`` by a rank file (A) and of ``text`` by a piece model (B).

    No merge of either crosses a single space between two other characters (checked for the
    piece model when it is loaded), so runs between such spaces are encoded once and remembered.
    Other texts are encoded whole.
    """

    def __init__(self, ranks: str, pieces: str, size: int = 500_000):
        import sentencepiece
        self.a = rank_encoder(ranks).ids
        self.names = [str(i) for i in range(1 << 16)]
        with open(ranks, "rb") as lines:
            words = {int(i): base64.b64decode(w) for w, i in (line.split() for line in lines if line.strip())}
        self.a_words = [words.get(i, b"") for i in range(max(words) + 1)]
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_words = [bytes([int(n[3:5], 16)]) if self.b.is_byte(i) else n.replace(SPACE_MARK, " ").encode()
                        for i, n in enumerate(names)]
        self.cuttable = not any(SPACE_MARK in n.lstrip(SPACE_MARK) for n in names)
        self.a_lengths = np.array([len(w) for w in self.a_words], "<u4")
        self.b_lengths = np.array([len(w) for w in self.b_words], "<u4")
        self.size = size
        self.known: dict[str, tuple[bytes, bytes] | None] = {}
        self.characters = 0

    def whole(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Ids of both as 32-bit numbers; none where the bytes of B are not the text's. Those of A, which knows all bytes, always are."""
        out, words = [], self.b_words
        for text, b in zip(texts, self.b.encode(texts, num_threads=1), strict=True):
            text = " " + text
            same = b"".join([words[i] for i in b]) == text.encode()
            out.append((array("I", self.a(text)).tobytes(), array("I", b).tobytes()) if same else None)
        return out

    def learn(self, texts: list[str]) -> None:
        """Encode the new runs of several texts together. A run with white space at its rim is left out: it depends on what is around it."""
        if self.cuttable:
            known = self.known
            runs = {r for text in texts for r in text.split(" ") if r not in known}
            free = [r for r in runs if r and not r[0].isspace() and not r[-1].isspace()]
            if len(known) >= self.size or self.characters > 16 * self.size:
                known.clear()
                self.characters = 0
            self.characters += sum(map(len, free))
            known.update(zip(free, self.whole(free), strict=True))

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both, or none: an empty text, or one that a tokenizer changes."""
        if not text:
            return None
        codes = [None]
        if self.cuttable:
            runs = text.split(" ")
            codes = list(map(self.known.get, runs))
            if None in codes:
                self.learn([text])
                codes = list(map(self.known.get, runs))
        if None in codes:
            codes = self.whole([text])
            if codes[0] is None:
                return None
        a, b = zip(*codes, strict=True)
        return np.frombuffer(b"".join(a), "<u4"), np.frombuffer(b"".join(b), "<u4")


@functools.lru_cache(maxsize=1)
def tokenizers(ranks: str, pieces: str) -> TwoTokenizers:
    return TwoTokenizers(ranks, pieces)


def aligned_text(coder: TwoTokenizers, text: str):
    """(ids of A, ids of B, stretches, ends of A, ends of B), or none without tokens."""
    ids = coder(text)
    if ids is None:
        return None
    ends_a, ends_b = np.cumsum(coder.a_lengths[ids[0]], dtype="i8"), np.cumsum(coder.b_lengths[ids[1]], dtype="i8")
    return *ids, common_ends(ends_a, ends_b), ends_a, ends_b


def align(docs: DataFrame, ranks: str | None = None, pieces: str | None = None) -> DataFrame:
    """Tokens of both tokenizers in groups, one row a document: ALIGNED.

    ``groups`` reads ``a1,a2|b1;a3|b2,b3``: ids of A and B in order, a group wherever tokens of
    both end. The last tokens of a group end together: ``pairs`` holds the different id pairs
    of a document's groups (A's id times 2^32 plus B's), ``times`` how often each occurs.
    A null or empty text, and one that a tokenizer does not give back byte by byte (B reads
    U+2581 as a space), has no tokens: zeros, an empty string and empty lists. Rows are
    independent of each other, a repeated row gives a repeated result.
    """
    ranks = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")
    pieces = pieces or public_tokenizers.path("piece_bpe_32k.model")

    def run(batches):
        coder = tokenizers(ranks, pieces)
        names = PairNames()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column("text").to_pylist()
                coder.learn(texts)
                rows = [row(coder, names, text) for text in texts]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id")] + [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    names=["doc_id", "n_a", "n_b", "n_groups", "groups", "pairs", "times"])

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(run, ALIGNED)


def row(coder: TwoTokenizers, names: PairNames, text: str) -> tuple:
    found = aligned_text(coder, text)
    if found is None:
        return 0, 0, 0, "", [], []
    a, b, stretches, ends_a, ends_b = found
    last_a, last_b, of = last_tokens(stretches, ends_a, ends_b)
    codes = a[last_a].astype("i8") << 32 | b[last_b].astype("i8")
    shown = list(map(names.__getitem__, codes.tolist()))
    several = np.flatnonzero(ends_a[stretches[of, 0]] != ends_b[stretches[of, 1]])
    text_of, ids_a, ids_b = coder.names, a.tolist(), b.tolist()
    for k, (i, j, x, y) in zip(several.tolist(), stretches[of[several]].tolist(), strict=True):
        shown[k] = ",".join([text_of[v] for v in ids_a[i:x]]) + "|" + ",".join([text_of[v] for v in ids_b[j:y]])
    pairs, times = np.unique(codes, return_counts=True)
    return len(a), len(b), len(shown), ";".join(shown), pairs, times.astype("i4")


def link_counts(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(pair, n, best) of all ``links`` (row, pair, times): a pair's count, and whether no pair of its B id has more."""
    counts = staged(spark, links.groupBy("pair").agg(F.sum("times").alias("n")), "pair-counts")
    b = F.col("pair").bitwiseAND(0xFFFFFFFF)
    most = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))  # one row a token of B's vocabulary at most
    return counts.withColumn("b", b).join(F.broadcast(most), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def link_scores(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """(row, n_links, n_best, count_sum) of ``rows`` (row, pairs, times), a row without links left out.

    Counts are over all rows. Pairs with a share of HOT_LINKS or more, of which there are at
    most 1 / HOT_LINKS, are looked up by broadcast; only the rare ones are shuffled, so no task
    of that join gets a hot pair, and sums are built before rows are sent.
    """
    links = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("e")).select(
        "row", F.col("e.pairs").alias("pair"), F.col("e.times").cast("long").alias("times"))
    counts = staged(spark, link_counts(spark, links), "pair-best")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = F.col("n") >= max(2.0, total * HOT_LINKS)
    hot = F.broadcast(counts.filter(often))
    known = links.join(hot, "pair").unionByName(
        links.join(hot.select("pair"), "pair", "left_anti").join(counts.filter(~often), "pair"))
    return known.groupBy("row").agg(F.sum("times").alias("n_links"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                    F.sum(F.col("times") * F.col("n")).alias("count_sum"))


def op12_token_alignment(spark: SparkSession, root: str) -> DataFrame:
    """Texts are tokenized once; what later steps need of them is written to the shared folder."""
    found = align(documents(spark, root))
    rows = staged(spark, found.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "n_a", "n_b", "n_groups", "pairs", "times",
        F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")), "aligned")
    scores = link_scores(spark, rows)
    zero = F.lit(0).cast("long")
    return rows.drop("pairs", "times").join(scores, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", *[F.coalesce(c, zero).alias(c) for c in ("n_links", "n_best", "count_sum")], "groups_sha256")
