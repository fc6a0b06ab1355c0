"""Memory of a Python worker."""
from __future__ import annotations

import random
import tracemalloc

import numpy as np
import public_tokenizers

from dieflow.llm import segmentations


def test_lattices_of_a_block_stay_small():
    words, draw = segmentations.lexicon(public_tokenizers.path("piece_bpe_32k.model")), random.Random(1)
    word = lambda: "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randint(3, 9)))
    texts, size = [], 0
    while size < segmentations.BLOCK:
        texts.append(" ".join(word() for _ in range(500)))
        size += len(texts[-1])
    tracemalloc.start()
    try:
        found = segmentations.sample_block(words, texts, np.arange(len(texts)), 2)
        peak = tracemalloc.get_traced_memory()[1] >> 20
    finally:
        tracemalloc.stop()
    assert [len(f) for f in found] == [2] * len(texts)
    assert peak < 80
