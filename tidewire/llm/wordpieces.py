"""A `tokenizers` file taken apart: white-space units, pre-tokens, ids. For one Python worker."""

from __future__ import annotations

import re
from collections.abc import Iterable

from tokenizers import Tokenizer

# Str.split() also splits at the four separators that are no white space for the tokenizer.
SEPARATORS = "\x1c\x1d\x1e\x1f"
BLANK = re.compile("[\t-\r \x85\xa0  -     　]+")


def byte_letters() -> dict[int, str]:
    """The visible characters that byte-level vocabularies write bytes with: printable ones stand for themselves."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {byte: chr(byte) for byte in shown} | {byte: chr(256 + i) for i, byte in enumerate(hidden)}


class WordPieces:
    """Ids of whole texts as the library gives them, but each distinct part is worked out once.

    If the pre-tokenizer drops white space, no token crosses it, and a text is as its white-space units. Otherwise
    a text is one unit.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = {token.content: i for i, token in added.items()}
        self.parts = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")
        self.letters = byte_letters()
        self.lower = [p for p, _ in self._library("A a")] == ["a", "a"]
        drops = len(self._library(" \n ")) == 0 and not any(BLANK.search(s) for s in self.special)
        self.by_blank = drops and not any(t.lstrip or t.rstrip or t.normalized for t in added.values())

    def _library(self, text: str) -> list[tuple[str, tuple[int, int]]]:
        if self.tokenizer.normalizer:
            text = self.tokenizer.normalizer.normalize_str(text)
        return self.tokenizer.pre_tokenizer.pre_tokenize_str(text)

    def units(self, text: str) -> Iterable[str]:
        """The text cut where no token can cross."""
        if not self.by_blank:
            return [text] if text else []
        if any(mark in text for mark in SEPARATORS):
            return [unit for unit in BLANK.split(text) if unit]
        return text.split()

    def pretokens(self, unit: str) -> list[str]:
        """The pre-tokens of a unit, in the vocabulary's letters, added tokens as they are."""
        # Short cut for plain Latin words: there normalization only lowers the case, and letters stay together.
        if self.by_blank and self.lower and (unit.isascii() or ("İ" not in unit and max(unit) < "ƀ")):
            if unit.isalpha():
                return [self._letters(unit.lower())]
            if unit[-1] in ".,;:!?" and unit[:-1].isalpha():
                return [self._letters(unit[:-1].lower()), unit[-1]]
        found, at = [], 0
        for part in self.parts.finditer(unit):
            found += [p for p, _ in self._library(unit[at : part.start()])] + [part[0]]
            at = part.end()
        return found + [p for p, _ in self._library(unit[at:])]

    def _letters(self, piece: str) -> str:
        return piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)

    def ids(self, pretoken: str) -> list[int]:
        if pretoken in self.special:
            return [self.special[pretoken]]
        return [token.id for token in self.tokenizer.model.tokenize(pretoken)]

    def count(self, pretoken: str) -> int:
        return 1 if pretoken in self.special else len(self.tokenizer.model.tokenize(pretoken))
