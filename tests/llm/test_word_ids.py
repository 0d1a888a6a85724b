"""Ids of the language model's words."""

import numpy as np
import public_tokenizers

from critiq.llm import attention_lm, packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_runs_of_letters_are_tokenized_once_for_all_lists(monkeypatch):
    asked = []

    class Counting:
        def __init__(self, model):
            self.model = model

        def tokenize(self, part):
            asked.append(part)
            return self.model.tokenize(part)

    def encoder(path, cached_words):
        encoded = packing.word_encoder(path, cached_words)
        encoded.model = Counting(encoded.model)
        return encoded

    monkeypatch.setattr(attention_lm, "word_encoder", encoder)
    ids = attention_lm.word_ids(PATH)
    first = ids([b"river", b"river,", b"Stone!?", b"stone"])
    again = ids([b"stone,", b"river!?", b"river"])
    assert sorted(asked) == sorted(["river", ",", "stone", "!?"])
    assert first[1].sum() == len(first[0]) and again[1].sum() == len(again[0])


def test_ids_are_the_tokenizers():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    words = [b"river,", "Über!?".encode(), "世界".encode(), b"<|endoftext|>", b"a<|endoftext|>b", b"isn't", b"...", b"1234", b"z" * 700,
             "ı.".encode(), "\U0001f600".encode()]
    flat, many = attention_lm.word_ids(PATH)(words)
    want = [tokenizer.encode(w.decode(), add_special_tokens=False).ids or [attention_lm.START_ID] for w in words]
    assert many.tolist() == [len(x) for x in want] and flat.tolist() == sum(want, [])
    flat, many = attention_lm.word_ids(PATH)([])
    assert len(flat) == len(many) == 0 and flat.dtype == np.dtype("<u2")


def test_words_in_are_the_words_of_each_text():
    texts = [b"Two words", None, b"", b" \t\n\x0b\x0c\r", "\u00c9t\u00e9 \u4e16\u754c\x00x\x1fy\u00a0z\n".encode(), b"x" * 70_000, b"\nEND "]
    words, many = attention_lm.words_in(texts)
    want = [attention_lm.words_of(t) for t in texts]
    assert many.tolist() == [len(w) for w in want] and words.to_pylist() == sum(want, [])
    words, many = attention_lm.words_in([])
    assert len(words) == 0 and len(many) == 0


def test_words_seen_before_need_no_pattern(monkeypatch):
    """A word whose run of letters has been seen is looked up as it is; the pattern is asked for the others alone."""
    asked = []

    class Plain:
        def __init__(self, pattern):
            self.pattern = pattern

        def fullmatch(self, word):
            asked.append(word)
            return self.pattern.fullmatch(word)

    def encoder(path, cached_words):
        encoded = packing.word_encoder(path, cached_words)
        encoded.plain = Plain(encoded.plain)
        return encoded

    monkeypatch.setattr(attention_lm, "word_encoder", encoder)
    ids = attention_lm.word_ids(PATH)
    first = ids([b"river", b"river", b"..."])
    asked.clear()
    again = ids([b"river", b"river", b"..."])
    assert asked == ["..."] and (first[0] == again[0]).all() and (first[1] == again[1]).all()
