"""Two tokenizers aligned, against the libraries and a plain walk over all ends."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import alignment

ODD = ["a", "  a  b ", "a\nb", "a\tb c", "<s>x</s> <s>", "<0x41> <|endoftext|> b", "é漢😀 é", "<unk>", " a", "\x00 b", "a" * 300 + " b",
       "▁x", "a▁b c", "word " * 30_000, "x " * 5 + " ", "​ zero", "don't  we'll 12,345.6"]


def brute(texts):
    """Groups and links by sets of ends, with both libraries on whole texts."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [x for x in range(256) if x not in letters]
    byte = {chr(x): x for x in letters} | {chr(256 + n): x for n, x in enumerate(rest)}

    def spelled(i):
        return bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    out, links = [], []
    for text in texts:
        found = a.encode(" " + (text or ""), add_special_tokens=False)
        ids = found.ids, b.encode(text or "")
        words = [bytes(map(byte.__getitem__, t)) for t in found.tokens], [spelled(i) for i in ids[1]]
        raw = (" " + (text or "")).encode()
        if not text or b"".join(words[0]) != raw or b"".join(words[1]) != raw:
            out.append((0, 0, 0, ""))
            links.append([])
            continue
        ends = [np.cumsum([len(w) for w in side]).tolist() for side in words]
        common = sorted(set(ends[0]) & set(ends[1]))
        groups, at = [], [0, 0]
        for end in common:
            to = [e.index(end, s) + 1 for e, s in zip(ends, at, strict=True)]
            groups.append("|".join(",".join(map(str, i[s:t])) for i, s, t in zip(ids, at, to, strict=True)))
            at = to
        out.append((len(ids[0]), len(ids[1]), len(groups), ";".join(groups)))
        where = {e: i for e, i in zip(ends[1], ids[1], strict=True)}
        links.append([(i, where[e]) for e, i in zip(ends[0], ids[0], strict=True) if e in where])
    return out, links


def test_probing_finds_the_first_difference():
    r = random.Random(1)
    for _ in range(500):
        a = [r.randrange(3) for _ in range(r.randint(0, 40))]
        b = a[:] + [r.randrange(3) for _ in range(r.randint(0, 3))]
        for _ in range(r.choice([0, 1, 2])):
            if b:
                b[r.randrange(len(b))] = 9
        i = j = r.randint(0, 3)
        want = next((k for k in range(min(len(a) - i, len(b) - j)) if a[i + k] != b[j + k]), max(0, min(len(a) - i, len(b) - j)))
        raw = [np.array(x, "<u4").tobytes() for x in (a, b)]
        assert alignment.same_from(*raw, i, j) == want


def test_common_ends_of_random_cuts():
    r = random.Random(2)
    for _ in range(300):
        n = r.randint(1, 60)
        a, b = (np.array(sorted({n, *r.sample(range(1, n + 1), r.randint(0, n))})) for _ in range(2))
        stretches = alignment.common_ends(a, b)
        last_a, last_b, _ = alignment.last_tokens(stretches, a, b)
        assert a[last_a].tolist() == b[last_b].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def test_rows_and_links_against_the_libraries(spark, make, varied, sample, tmp_path, monkeypatch):
    monkeypatch.setattr(alignment, "HOT_LINKS", 2e-3)  # both ways of looking a pair up
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100 + i, t) for i, t in varied] + [(1000 + i, t) for i, t in sample[:80]] + [(1000, sample[0][1]), (None, "a b c")]
    make(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = alignment.op12_token_alignment(spark, str(tmp_path)).collect()
    want, links = brute([t for _, t in rows])
    counts = Counter(link for of in links for link in of)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    expected = [(i, n_a, n_b, n, len(of), sum(counts[x] == most[x[1]] for x in of), sum(counts[x] for x in of),
                 hashlib.sha256(groups.encode()).hexdigest() if groups else "")
                for (i, _), (n_a, n_b, n, groups), of in zip(rows, want, links, strict=True)]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)


def test_no_documents(spark, make, tmp_path):
    make([]).write.parquet(str(tmp_path / "a" / "documents.parquet"))
    assert alignment.op12_token_alignment(spark, str(tmp_path / "a")).count() == 0
    make([(1, None), (2, "")]).write.parquet(str(tmp_path / "b" / "documents.parquet"))
    assert {tuple(r) for r in alignment.op12_token_alignment(spark, str(tmp_path / "b")).collect()} == {(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)}
