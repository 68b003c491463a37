"""Texts over one block keep their words whole."""

import pytest

from tidemark.llm import common, jaccard


@pytest.mark.parametrize("space", [b" ", b"\n", b"\t", b"\r", b"\v", b"\f"])
def test_words_survive_block_borders(space):
    many = space.join(b"word%d" % i for i in range(200_000))
    long = space.join([b"a", b"x" * (common.CUT * 3 // 2), b"b", b"y" * (2 * common.CUT), b"c"])
    for raw in (many, long, space + many, b"z" * (common.CUT + 1)):
        parts = list(common.cuts(raw))
        assert b"".join(parts) == raw
        assert [w for part in parts for w in part.split()] == raw.split()
    assert max(map(len, common.cuts(many))) <= common.CUT


def test_long_copies_have_the_same_shingles():
    text = "\t".join(f"word{i}" for i in range(300_000))
    memo = jaccard._WordHashes()
    assert jaccard.shingles(text, 4, memo).tolist() == jaccard.shingles(text.replace("\t", " "), 4, memo).tolist()
