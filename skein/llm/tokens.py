"""Exact token ids of whole texts, fast: the tokenizers library merges each distinct piece once.

Both vocabularies cut a text at white space before they merge, so the ids of a text are those of its
pieces in order. A bounded dictionary keeps the ids of pieces seen before and learns a new one when a text first asks for it, so
a text is gone through once. A new piece that is a word with or without punctuation after it, as nearly
all are, goes to the library's merge model in those two parts, as its own splitter would cut it. For the
byte-level vocabulary, other printable ASCII is cut by that splitter's pattern, and its parts go there
too. Any other piece is encoded by the library as it stands.
So is every piece with the literal of an added token (`<|endoftext|>`), which gets that token's id: the
literals begin with punctuation and have no white space, so no cut goes through one.
Texts with unusual white space are cut only where one space stands between two other characters,
which is a safe place in every text; a text with NUL is encoded by the library as it stands.
"""

from __future__ import annotations

import os
import re
import string
from array import array

#: Pieces kept by one Python worker, some 300 bytes each; at the bound it starts afresh.
CACHE_PIECES = 600_000
_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")
_OTHER_SPACE = re.compile(r"[^\S \n]")
_PYTHON_ONLY_SPACE = re.compile(r"[\x1c-\x1f]")
#: Letters below this need no composition, and lower-case one by one.
_PLAIN_LETTERS = "ɐ"
#: What the byte-level splitter leaves whole, in printable ASCII without a space but the first.
_ASCII_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^ A-Za-z0-9]+")


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable bytes stand for
    themselves, the others follow from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(256 + others.index(b)) for b in range(256)]


_BYTE_CHARACTERS = dict(enumerate(byte_characters()))


def _ids(ids) -> bytes:
    return array("I", ids).tobytes()


class Encoder:
    """Ids as little-endian unsigned 32-bit integers. kind: `byte` for the byte-level vocabulary,
    `word` for the one that drops white space."""

    def __init__(self, path: str, kind: str, most: int = CACHE_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.most = most
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words = kind == "word"
        self.pieces = self._word_pieces if self.words else self._byte_pieces
        self.cache = _Learning(self._learned)
        self.parts: dict[str, bytes] = {}

    @staticmethod
    def _byte_pieces(text: str) -> list[str]:
        """A piece stands for itself after a space; one that starts with NUL, for the rest of itself
        with nothing before; a newline for itself."""
        if "  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[:1].isspace() or text[-1:].isspace() or _OTHER_SPACE.search(text):
            first, *rest = _SAFE_SPACE.split(text)
            return ["\0" + first, *rest]
        return ("\0" + text.replace("\n", " \n \0")).split(" ")

    @staticmethod
    def _word_pieces(text: str) -> list[str]:
        pieces = text.split() if not _PYTHON_ONLY_SPACE.search(text) else re.split(r"[ \n]+", text)
        return ["\0" + x for x in pieces] if "\0" in text else pieces

    def _plain(self, piece: str) -> str:
        if piece[:1] == "\0":
            return piece[1:]
        return piece if piece == "\n" or self.words else " " + piece

    def _merged(self, plain: str) -> bytes:
        """Ids of what the library's splitter leaves whole."""
        if plain.isascii() and not self.words:
            shown = "Ġ" + plain[1:] if plain[0] == " " else plain
        else:
            shown = (plain.lower() if self.words else plain).encode().decode("latin-1").translate(_BYTE_CHARACTERS)
        return _ids([t.id for t in self.model.tokenize(shown)])

    def _part(self, plain: str) -> bytes:
        got = self.parts.get(plain)
        if got is None:
            got = self.parts[plain] = self._merged(plain)
        return got

    def _learned(self, piece: str) -> bytes:
        """Ids of a piece not seen before. A word with punctuation after it is the word, which may have
        been seen, and the punctuation."""
        bare = piece.rstrip(string.punctuation)
        if bare != piece and bare and bare != "\0" and self._is_word(bare):
            return self.cache[bare] + self._part(piece[len(bare) :])
        plain = self._plain(piece)
        if bare == piece and self._is_word(piece):
            return self._merged(plain)
        if not self.words and plain.isascii() and plain.isprintable() and plain != " " and " " not in plain[1:] and "<|" not in plain:
            return b"".join(map(self._part, _ASCII_PARTS.findall(plain)))
        return _ids(self.tokenizer.encode(plain, add_special_tokens=False).ids)

    @staticmethod
    def _is_word(piece: str) -> bool:
        letters = piece[1:] if piece[:1] == "\0" else piece
        return letters.isalpha() and (letters.isascii() or (max(letters) < _PLAIN_LETTERS and "İ" not in letters))

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.words and "\0" in text:
            return _ids(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if len(self.cache) > self.most:
            self.cache.clear()
            self.parts.clear()
        return b"".join(map(self.cache.__getitem__, self.pieces(text)))


class _Learning(dict):
    """Ids by piece; learns a piece when it is first asked for."""

    def __init__(self, learned):
        self.learned = learned

    def __missing__(self, piece: str) -> bytes:
        got = self[piece] = self.learned(piece)
        return got


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, kind: str, most: int = CACHE_PIECES) -> Encoder:
    """One encoder for each vocabulary and Python worker, which keeps so many pieces."""
    if (path, kind) not in _ENCODERS:
        _ENCODERS[path, kind] = Encoder(path, kind)
    _ENCODERS[path, kind].most = most
    return _ENCODERS[path, kind]
