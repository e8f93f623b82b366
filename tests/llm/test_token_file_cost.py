"""op3: the coder's cost of a token, odd blocks, and the word encoder with full caches."""

from __future__ import annotations

import time

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from cellscope.llm import range_coder, token_file
from tests.llm.test_text_operators import mixed_texts


def _cpu(run) -> float:
    start = time.process_time()
    run()
    return time.process_time() - start


def test_coding_a_token_costs_few_array_operations():
    """In gathers of one number a lane, so that the machine's speed does not matter (200 of them; 829 when order 0 was renewed at each token)."""
    rng = np.random.default_rng(3)
    blocks = list((rng.zipf(1.3, (1024, 512)) % 600).astype(np.uint32))
    table, at = np.zeros(1 << 22, np.uint16), rng.integers(0, 1 << 22, (64, 1024))
    gathers = lambda: [table.take(at[k % 64]) for k in range(512 * 40)]
    work = lambda: range_coder.decode_blocks(range_coder.encode_blocks(blocks))
    cost = min(_cpu(work) for _ in range(2)) / (min(_cpu(gathers) for _ in range(2)) / 40)
    assert cost < 400


def test_blocks_of_all_lengths_and_alphabets():
    rng = np.random.default_rng(5)
    blocks = [rng.integers(0, 1 + rng.integers(1, 5000), n).astype(np.uint32) for n in rng.integers(0, 700, 150)]
    blocks += [rng.permutation(4096).astype(np.uint32), np.full(4096, 2 ** 32 - 1, np.uint32), np.arange(4096).astype(np.uint32),
               np.repeat(np.arange(8), 512).astype(np.uint32), (rng.zipf(1.2, 4096) % 4096).astype(np.uint32)]
    coded = range_coder.encode_blocks(blocks)
    assert all(np.array_equal(a, b) for a, b in zip(range_coder.decode_blocks(coded), blocks))
    # A block's bytes do not depend on those coded in step with it.
    assert [range_coder.encode_blocks([b])[0] for b in blocks[-8:]] == coded[-8:]
    assert all(np.array_equal(range_coder.decode_blocks([c])[0], b) for b, c in zip(blocks[-8:], coded[-8:]))


def test_word_encoder_with_full_caches(monkeypatch):
    monkeypatch.setattr(token_file, "CACHE_WORDS", 60)
    monkeypatch.setattr(token_file, "CHUNK_CHARS", 400)
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = mixed_texts(200) + ["", " ", "\t\x0b a\x0c\r\nb ", "don't!!'s 'll x'RE 1234 ÀÉß?", "</w> a</w>b \x00\x01", "<|endoftext|> a", "\x85a\xa0b"]
    library = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    encoder = token_file.WordEncoder(path)
    for _ in range(2):
        assert [list(x) for x in encoder(iter(texts))] == [e.ids for e in library]
