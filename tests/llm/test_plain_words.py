"""Token ids of plain words, which need no pattern."""

import numpy as np

from clickstrata.llm import tokens

PLAIN = ["hello", "Été,", "WORD.", "x1", "don'", "naïve÷", "Ÿs", "a", "ß!", "reader's", "'s", "12", "ªb", "µm", "b²", "été×"]


def test_ids_of_plain_words_are_the_tokenizers():
    coder = tokens.WordIds()
    for word, ids in zip(PLAIN, coder.encode(PLAIN)):
        wanted = coder.tokenizer.encode(word, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == wanted


def test_plain_words_need_no_pattern(monkeypatch):
    coder = tokens.WordIds()
    monkeypatch.setattr(tokens, "PARTS", None)
    assert all(coder.encode(["hello Été, WORD. x1 naïve÷"]))
