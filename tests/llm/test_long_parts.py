"""Long texts without blanks and long runs of blanks."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from linkloom.llm import packing, token_counts

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def test_token_counts_of_thousands_of_characters_without_a_blank():
    counter = token_counts.Counter(token_counts.load_ranks(PIECES))
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    r = random.Random(4)
    han = "".join(chr(r.randrange(0x4E00, 0x9FA0)) for _ in range(5000))
    mixed = "".join(r.choices(["日", "本", "語", "1", "7", "the", "ing", "😀", "é", ".", "▁"], k=5000))
    for text in (han, "1" * 6000, "😀" * 3000, "".join(r.choices("0123456789", k=5000)), mixed, "a" + "1" * 3000 + "b"):
        assert counter.count(text) == len(library.encode(text))


@pytest.mark.parametrize("end", ["b", "b<|endoftext|>"])
def test_ids_of_a_long_run_of_blanks(end):
    text = "a" + " " * 1_100_000 + end
    want = Tokenizer.from_file(BYTES).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.Encoder(BYTES).ids(text), "<u4").tolist() == want
