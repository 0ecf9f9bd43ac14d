"""Token ids of texts, for a tokenizer that drops white space.

Such a tokenizer treats each run of other characters for itself, so a text's
ids are those of its words in a row, and each distinct word is encoded once.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterable
from os.path import commonprefix

TOKENIZER = "word_bpe_49k.json"
# Words, and parts of words, remembered by a worker.
REMEMBERED = 200_000
# Characters handled at once.
AT_ONCE = 1 << 20
# Rows whose texts become Python strings at once.
ROWS_AT_ONCE = 128

# Words of these characters are normalized and split here, which is faster; the
# rules are the tokenizer's own. Any other word goes through the tokenizer whole.
SIMPLE = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def byte_letters() -> dict[int, str]:
    """The visible character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + at) for at, b in enumerate(hidden)}


class PartIds(dict):
    """The ids of the parts of normalized words."""

    def __init__(self, model):
        self.tokenize = model.tokenize
        self.letters = byte_letters()
        self.earlier: dict[str, bytes] = {}

    def __missing__(self, part: str) -> bytes:
        ids = self.earlier.get(part)
        if ids is None:
            shown = part
            if not part.isascii():
                shown = "".join(map(self.letters.__getitem__, part.encode()))
            ids = array("I", [token.id for token in self.tokenize(shown)]).tobytes()
        self[part] = ids
        return ids

    def trim(self) -> None:
        """Forget what was not used lately."""
        if len(self) > REMEMBERED:
            self.earlier = dict(self)
            self.clear()


# How a tokenizer must split for its words to be encoded one by one.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordIds(dict):
    """Encodes texts to little-endian unsigned 32-bit ids; remembers the ids of words.

    ``special``: whether the strings of special tokens in a text give those tokens' ids, as
    the tokenizer does by itself, or are ordinary text. A tokenizer with other rules for
    words is refused.
    """

    def __init__(self, tokenizer: str | None = None, special: bool = False):
        from tokenizers import Tokenizer

        if tokenizer is None:
            import public_tokenizers

            tokenizer = public_tokenizers.path(TOKENIZER)
        self.tokenizer = Tokenizer.from_file(tokenizer)
        with open(tokenizer, encoding="utf-8") as rules:
            known = f'"pattern":{{"Regex":{json.dumps(WORD_PATTERN)}}}' in rules.read()
        if not known:
            raise ValueError("this tokenizer does not drop white space between words")
        self.tokenizer.encode_special_tokens = not special
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [token.content for token in added] if special else []
        # What all of them begin with; without special tokens, what no word holds.
        self.mark = commonprefix(self.special).encode() if self.special else b" "
        self.parts = PartIds(self.tokenizer.model)
        self.earlier: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.earlier.get(word)
        if ids is None:
            ids = self._encoded(word)
        self[word] = ids
        return ids

    def _encoded(self, word: bytes) -> bytes:
        text = word.decode()
        if self.mark in word and any(token in text for token in self.special):
            pass
        elif text.isascii() and text.isprintable() or SIMPLE.fullmatch(text):
            low = text.lower()
            # Most words are letters alone, or with one other character at the end.
            if low.isalpha():
                return self.parts[low]
            if low[:-1].isalpha():
                return self.parts[low[:-1]] + self.parts[low[-1]]
            return b"".join(map(self.parts.__getitem__, PARTS.findall(low)))
        found = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", found).tobytes()

    def trim(self) -> None:
        """Forget what was not used lately."""
        if len(self) > REMEMBERED:
            self.earlier = dict(self)
            self.clear()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, four bytes each."""
        self.trim()
        self.parts.trim()
        of = self.__getitem__
        # bytes.split() cuts at ASCII white space, which the tokenizer drops.
        return [b"".join(map(of, text.encode().split())) for text in texts]


def slices(batch, text: str = "text", at_once: int = AT_ONCE) -> Iterable[tuple[int, list[str]]]:
    """(first row, texts) of runs of rows that hold a bounded amount of text; null as empty."""
    first, size, some = 0, 0, []
    for at in range(0, batch.num_rows, ROWS_AT_ONCE):
        for row, value in enumerate(batch.column(text).slice(at, ROWS_AT_ONCE).to_pylist(), at):
            some.append(value or "")
            size += len(some[-1])
            if size >= at_once:
                yield first, some
                first, size, some = row + 1, 0, []
    if some:
        yield first, some
