"""Added tokens quoted in a text."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing


@pytest.mark.parametrize("text", ["hello <|endoftext|> world", "<|endoftext|>", "<|endoftext|><|endoftext|> a  b", "a<|endoftext|>b", "<|endoftext|", "x\n<|endoftext|>\n y <|ENDOFTEXT|>"])
def test_added_tokens_equal_tokenizers(text):
    coder = packing.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert np.frombuffer(coder.encode(text), "<u4").tolist() == want.encode(text, add_special_tokens=False).ids
