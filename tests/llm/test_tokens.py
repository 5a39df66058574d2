import random

import numpy as np
import pytest

from changeledger.llm import tokens

PIECES = ["a", "É", "İ", "ſ", "Σ", "word", "Word", "WORD!!", "x***", "it's", "don't", "'s", "'", "''", '"q"', "1", "12.5", "½",
          "é", "́", "क़", "日本", "😀", "​", "\xa0", " ", "\t", "\n", "\n\n", "\r\n", " ", "  ", "\x1c", "\x85", "\x00",
          ".", ",", "...", "—", "<|endoftext|>", "_", "a_b", "a-b,", "Ǆ", "ß", "ŉ,"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_equal_the_library_s(name, monkeypatch):
    """On texts of odd spaces, marks, case and punctuation, also while the memo keeps starting anew."""
    monkeypatch.setattr(tokens, "MEMO_CHUNKS", 500)
    monkeypatch.setattr(tokens, "BATCH_BYTES", 5000)
    rng = random.Random(3)
    texts = ["".join(rng.choice(PIECES) + rng.choice(["", " ", " ", "\n"]) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    e = tokens.Encoder(tokens.vocabulary_path(name))
    got = [np.frombuffer(x, e.dtype).tolist() for i in range(0, 4000, 700) for x in e.encode_many(texts[i:i + 700])]
    assert got == [x.ids for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert e.encode_many([]) == [] and e.encode_many(["", ""]) == [b"", b""]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_added_tokens_in_a_text_are_one_id(name):
    """As the library reads them by default; held against a tokenizer that no code here has touched."""
    from tokenizers import Tokenizer

    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "|>", "word", "Word,", " ", "\n", "<|<|endoftext|>|>"]
    rng = random.Random(8)
    texts = ["Hello <|endoftext|> world", "<|endoftext|>", "a<|endoftext|>b <|startoftext|>", "plain text", ""]
    texts += ["".join(rng.choices(parts, k=rng.randint(1, 8))) for _ in range(500)]
    plain = Tokenizer.from_file(tokens.vocabulary_path(name))
    e = tokens.Encoder(tokens.vocabulary_path(name))
    got = [np.frombuffer(x, e.dtype).tolist() for x in e.encode_many(texts)]
    assert got == [x.ids for x in plain.encode_batch(texts, add_special_tokens=False)]
    assert plain.token_to_id("<|endoftext|>") in got[0]
