"""Token ids of the packing's encoder against the tokenizer itself."""

from __future__ import annotations

import random

import numpy as np
from public_tokenizers import path

from tidegrid.llm import packing


def test_ids_equal_the_tokenizers_around_all_white_space_and_without_looking_ahead():
    encoder, rng = packing._Encoder(path("byte_bpe_50k.json")), random.Random(5)
    assert "(?!" not in encoder.ranked._pat_str
    signs = [" ", " ", "  ", "\n", "\n\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0", " ", "　", "​", "a", "Bc", "'", "'s", "1", "é", ".", "-", "中", "😀", "́"]
    for _ in range(3000):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(14)))
        whole = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert encoder.ids(text) == np.array(whole, "<u4").tobytes(), repr(text)


def test_a_worker_makes_its_encoder_once():
    assert packing._encoder(path("byte_bpe_50k.json")) is packing._encoder(path("byte_bpe_50k.json"))
