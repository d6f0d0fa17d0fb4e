"""Token ids of whole texts by a public tokenizer file, with a bounded cache of words."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np

TOKENIZER = "word_bpe_49k.json"
CACHED_WORDS = 800_000
#: Characters of text taken at a time; bounds the memory for split words.
PIECE_CHARS = 1 << 20

# The tokenizer's words never hold white space, and over these characters its steps are plain: no normalisation
# applies, lower case is by character, and a word is a run of letters, one digit, a clitic, or a run of the rest.
_PLAIN = re.compile("[\t-\r -~À-ÖØ-öø-ÿ]*")
_WORDS = re.compile("[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\\sa-z0-9ß-öø-ÿ]+")
_CUT = re.compile("[\t-\r ]")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """``ids(text)`` equals ``encode(text, add_special_tokens=False).ids`` of the file, as unsigned 32-bit bytes.

    Words are encoded once and then looked up. A text with any other character, or with the text of a special
    token, is cut at white space and its odd parts go to the tokenizer as they are.
    """

    _made: dict[str, Encoder] = {}

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        plain = map(chr, range(33, 256))
        first = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.letters = {ord(c): first(c)[0][0] for c in plain if _PLAIN.fullmatch(c)}
        self.words: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> Encoder:
        """One encoder, and so one cache, per worker process."""
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def _raw(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        """Encode words that aren't cached, by the tokenizer's model alone: they are what its first steps give."""
        for word in words:
            found = self.tokenizer.model.tokenize(word.translate(self.letters))
            self.words[word] = array("I", [t.id for t in found]).tobytes()

    def _is_plain(self, text: str) -> bool:
        return bool(_PLAIN.fullmatch(text)) and not any(s in text for s in self.special)

    def _piece(self, text: str) -> bytes:
        if not self._is_plain(text):
            return b"".join(
                self._piece(part) if self._is_plain(part) else self._raw(part) for part in _CUT.split(text) if part
            )
        words, known = _WORDS.findall(text.lower()), self.words
        try:
            return b"".join(map(known.__getitem__, words))
        except KeyError:
            if len(known) > CACHED_WORDS:
                known.clear()
            self._learn([w for w in set(words) if w not in known])
        return b"".join(map(known.__getitem__, words))

    def ids(self, text: str) -> bytes:
        if len(text) <= PIECE_CHARS:
            return self._piece(text)
        return b"".join(map(self._piece, pieces(text, PIECE_CHARS)))


def pieces(text: str, size: int) -> Iterator[str]:
    """The text in parts of about ``size`` characters, cut at white space only."""
    start = 0
    while start < len(text):
        end = start + size
        if end < len(text):
            space = _CUT.search(text, end)
            end = space.start() if space else len(text)
        yield text[start:end]
        start = end
