"""Ids of a tokenizer whose tokens never span white space, by white-space separated chunks."""

from __future__ import annotations

import os
import unicodedata

import regex

from sparkbourse.llm.chunks import Kept

#: Fixed values of the tokenizer's file: how normalised text splits before the merges.
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Python takes these for white space, Unicode and the tokenizer don't.
NO_SPACE = "\x1c\x1d\x1e\x1f"


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: printable ones for themselves, the rest from code point 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordTokens:
    """``encode(text)`` gives the ids, little-endian unsigned 32-bit, that the whole tokenizer would give.

    A chunk's ids do not depend on its neighbours, since normalising and splitting never look across white space. A text
    that holds the string of a special token, which becomes that token wherever it stands, goes through the tokenizer whole.
    """

    def __init__(self, path: str, keep: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        self._special = [token.content for token in self._whole.get_added_tokens_decoder().values()]
        self._tokenize = self._whole.model.tokenize
        self._split, self._letters = regex.compile(PRETOKENS).findall, byte_letters()
        self._words, self._chunks = Kept(self._word, keep), Kept(self._chunk, keep)

    def _word(self, word: str) -> bytes:
        letters = word.encode().decode("latin-1").translate(self._letters)
        return b"".join([token.id.to_bytes(4, "little") for token in self._tokenize(letters)])

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isascii() or "Σ" not in chunk and unicodedata.is_normalized("NFC", chunk):
            if not chunk.isascii() and any(unicodedata.category(c) == "Cn" for c in chunk):
                return self._plain(chunk)  # characters that not every Unicode version has
            chunk = chunk.lower()  # a capital sigma would turn out otherwise at the end of a word
            if chunk.isalpha():
                return self._words[chunk]
            if chunk[:-1].isalpha() and chunk[-1] in ".,":
                return self._words[chunk[:-1]] + self._words[chunk[-1]]
        else:
            return self._plain(chunk)
        return b"".join([self._words[word] for word in self._split(chunk)])

    def _plain(self, text: str) -> bytes:
        return b"".join([i.to_bytes(4, "little") for i in self._whole.encode(text, add_special_tokens=False).ids])

    def encode(self, text: str) -> bytes:
        if any(c in text for c in (*NO_SPACE, *self._special)):
            return self._plain(text)
        ids = b"".join(map(self._chunks.__getitem__, text.split()))
        self._words.turn()
        self._chunks.turn()
        return ids
