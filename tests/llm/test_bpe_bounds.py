"""What a worker holds can be bounded by the caller, and the ids stay the same."""

import public_tokenizers

from tablemargin.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_bounds_of_the_caller_hold():
    spec = bpe.read_tokenizer(PATH)
    small, usual = bpe.Encoder(spec | {"cached": 50, "slice": 64}), bpe.Encoder(spec)
    texts = [" ".join(f"w{i % 170}x" for i in range(a, a + 40)) for a in range(0, 2000, 40)]
    assert [x.tolist() for x in small.encode_all(texts)] == [x.tolist() for x in usual.encode_all(texts)]
    assert len(small.words) <= 50 and len(small.words.old) <= 50
    assert len(usual.words) > 50
