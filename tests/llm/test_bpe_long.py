import random
import time

import pytest
import tiktoken

from ledgerflow.llm import bpe


@pytest.fixture(scope="module")
def both():
    import public_tokenizers as pt
    with open(pt.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = bpe.parse_ranks(f.read())
    return ranks, pt.PATTERN, tiktoken.Encoding("x", pat_str=pt.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_very_long_words_take_time_in_proportion(both):
    ranks, pattern, library = both
    encoder, rng, took = bpe.Encoder(ranks, pattern), random.Random(1), []
    for n in (20_000, 160_000):
        word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
        begin = time.perf_counter()
        ids = encoder(word)
        took.append(time.perf_counter() - begin)
        assert ids.tolist() == library.encode_ordinary(word)
        assert word not in encoder.kept
    assert took[1] < 40 * took[0]  # eight times the length; a quadratic walk would take 64 times as long


def test_stores_that_start_anew_inside_a_word_change_nothing(both, monkeypatch):
    ranks, pattern, library = both
    monkeypatch.setattr(bpe, "KEEP", 50)
    encoder, rng = bpe.Encoder(ranks, pattern), random.Random(2)
    texts = ["".join(rng.choice("abcé日 \n01,'") for _ in range(3000)), "x" * 5000, " the of and " * 200, "ab" * 2000 + " " + "ab" * 2001, ""]
    for text in [*texts, *texts]:
        assert encoder(text).tolist() == library.encode_ordinary(text)
        assert len(encoder.transducer.steps) <= 51 and len(encoder.kept) <= 51 + len(set(encoder.split(text)))
