"""Token ids through the tokenizer library with a bounded worker cache of pre-tokens.

A text is cut where the tokenizer's own splitting always cuts, each distinct piece is encoded once
by the library, and the ids of a text are the cached pieces joined. Cuts are only made where the
library gives the same ids for the pieces as for the whole; texts with unusual white space go to
the library whole.
"""

from __future__ import annotations

import json
import os
import re
from itertools import islice
from struct import pack
from unicodedata import is_normalized

import public_tokenizers

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: A byte-level vocabulary glues one space to the next word: a cut stands before a run of blanks.
_SPACED = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_ODD_BLANK = re.compile(r"[^\S \n]")
#: Letters and a run of marks after them are always split, so both halves can be looked up.
_MARKS = ".,!*#$%&"
#: Longer keys are not kept, so the cache is bounded in bytes too; letters from here on are left to
#: the library, whose tables may know others.
_LONGEST, _NEW = 64, "\u2000"


def _shown() -> dict[int, str]:
    """Byte-level vocabularies write a byte as its Latin-1 character if that is visible, and the
    others, in order, as the characters from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(others)}


_SHOWN = _shown()


def plain(text: str) -> bool:
    """Whether every run of white space is one space or one line feed between two words."""
    words = text.split()
    return "\0" not in text and len(text) - sum(map(len, words)) == len(words) - 1 == text.count(" ") + text.count("\n")


class PieceIds(dict):
    """piece -> its ids as little-endian unsigned 32-bit integers; half of it goes at ``limit`` pieces.

    ``split`` gives the keys of a text and ``piece`` the text that a key stands for.
    """

    def __init__(self, path: str, limit: int = 600_000):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.merges = self.tokenizer.model.tokenize
        model = json.loads(self.tokenizer.to_str())["model"]
        self.word_ends = bool(model.get("end_of_word_suffix"))
        self.split, self.piece = (self.words, self.decoded) if self.word_ends else (self.spaced, self.unspaced)

    @staticmethod
    def words(text: str) -> list[bytes]:
        """Word-end vocabularies drop white space and lower-case: every ASCII blank is a cut."""
        own = text.encode("utf-8", "surrogatepass")
        return (own if "<|" in text else own.lower()).split()

    @staticmethod
    def decoded(key: bytes) -> str:
        return key.decode("utf-8", "surrogatepass")

    @staticmethod
    def spaced(text: str) -> list[str]:
        """Keys are words as they follow a space, except that a key after NUL is a piece as it is."""
        if plain(text):
            first, *rest = text.replace("\n", " \n").split(" ")
            return ["\0" + first, *rest]
        own = [text] if _ODD_BLANK.search(text) else _SPACED.findall(text)
        return ["\0" + p for p in own]

    @staticmethod
    def unspaced(key: str) -> str:
        return key[1:] if key[0] == "\0" else key if key[0] == "\n" else " " + key

    def __missing__(self, key) -> bytes:
        value = self.learned(key)
        if len(key) <= _LONGEST:
            self[key] = value
        return value

    def learned(self, key) -> bytes:
        """The ids of a key by the library: all of it, or for a word of letters, which its splitting
        never cuts and its normalizer doesn't change, by its merges alone."""
        if not self.word_ends and key[0] == "\n" and len(key) > 1:  # a line feed is a pre-token
            return self["\0\n"] + self["\0" + key[1:]]
        piece = self.piece(key)
        if piece[-1] in _MARKS:
            base = piece.rstrip(_MARKS)
            if base[-1:].isalpha() and base[-1] < _NEW and "<|" not in base:
                marks = piece[len(base) :]
                return self[base.encode()] + self[marks.encode()] if self.word_ends else self[key[: -len(marks)]] + self["\0" + marks]
        word = piece[1:] if piece[0] == " " else piece
        if word.isalpha() and max(word) < _NEW and (not self.word_ends or (word.islower() and is_normalized("NFC", word))):
            ids = [t.id for t in self.merges(piece.encode().decode("latin-1").translate(_SHOWN))]
        else:
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        return pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        out = []
        for text in texts:
            if len(self) > self.limit:
                # frequent pieces are met early, and a dict keeps its order
                first = list(islice(self.items(), self.limit // 2))
                self.clear()
                self.update(first)
            out.append(b"".join(map(self.__getitem__, self.split(text))))
        return out


_loaded: dict[str, PieceIds] = {}


def encoder(path: str) -> PieceIds:
    """One cache for each Python worker and vocabulary."""
    if path not in _loaded:
        _loaded[path] = PieceIds(path)
    return _loaded[path]


def vocabulary(name: str) -> str:
    """Where this machine keeps a public vocabulary; called on the worker that needs it."""
    return name if os.path.isabs(name) else public_tokenizers.path(name)
