"""Token ids of whole texts by a tokenizer file, with the ids of each distinct word kept for the next time it occurs.

The tokenizer in use drops white space and never joins what white space separates, so a text's ids are the ids of its
words in turn. A text is cut at ASCII white space only; other white space stays inside a word. A word of plain Latin
characters is cut further by the tokenizer's own splitting pattern, and each part goes to its BPE model; any other
word goes through the whole tokenizer.
"""

from __future__ import annotations

import json

import numpy as np
import regex
from tokenizers import Tokenizer

_SLICE = 1 << 20
# Words remembered by a Python worker, and as many of their parts, at about 180 bytes each.
REMEMBERED = 200_000
# Characters whose normal form is themselves and whose lower case is one character; no white space among them.
_PLAIN = regex.compile("[\x21-\x7e\xa1-\u012f\u0131-\u024f]+")
_SPECIAL = b"<|"


def _byte_letters() -> list[str]:
    """How byte-level models write bytes: printable Latin-1 as itself, the rest from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Recent:
    """The ids of the words met last: a young and an old half.

    A word found in the old half moves to the young one. When that is full it becomes the old one, and what nobody asked
    for since the last time goes.
    """

    def __init__(self, size: int):
        self.half, self.young, self.old = max(size // 2, 1), {}, {}

    def get(self, word):
        ids = self.young.get(word)
        if ids is None:
            ids = self.old.get(word)
            if ids is not None:
                self.put(word, ids)
        return ids

    def put(self, word, ids: bytes) -> None:
        if len(self.young) >= self.half:
            self.old, self.young = self.young, {}
        self.young[word] = ids


class WordTokenizer:
    """Ids of texts as little-endian unsigned 16- or 32-bit numbers; texts are bytes.

    For tokenizer files of one layout: NFC, white space and lower case normalized; split by one pattern; byte-level BPE.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            layout = json.load(file)
        steps = [s["type"] for s in layout["normalizer"]["normalizers"]]
        split, last = layout["pre_tokenizer"]["pretokenizers"]
        if steps != ["NFC", "Replace", "Lowercase"] or split["type"] != "Split" or last["type"] != "ByteLevel":
            raise ValueError(f"{path} has another layout")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        small = self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16
        self.width = np.dtype("<u2" if small else "<u4")
        size = self.width.itemsize
        self.packed = [i.to_bytes(size, "little") for i in range(self.tokenizer.get_vocab_size(with_added_tokens=True))]
        self.letters = _byte_letters()
        self.words, self.parts = Recent(remembered), Recent(remembered)

    def _packed(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.width).tobytes()

    def _part(self, part: str) -> bytes:
        text = part if part.isascii() else "".join([self.letters[b] for b in part.encode()])
        packed = self.packed
        ids = b"".join([packed[t.id] for t in self.tokenizer.model.tokenize(text)])
        self.parts.put(part, ids)
        return ids

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if _SPECIAL in word or not (text.isascii() and text.isprintable() or _PLAIN.fullmatch(text)):
            return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        text, known = text.lower(), self.parts
        if text.isalpha():  # letters are one part; so is a closing mark
            return known.get(text) or self._part(text)
        if text[-1] in ".,;:!?" and text[:-1].isalpha():
            return (known.get(text[:-1]) or self._part(text[:-1])) + (known.get(text[-1]) or self._part(text[-1]))
        return b"".join([known.get(p) or self._part(p) for p in self.pattern.findall(text)])

    def ids(self, text: bytes) -> np.ndarray:
        found, low = [], 0
        while low < len(text):
            high = low + _SLICE
            while high < len(text) and not text[high : high + 1].isspace():
                high += 1
            piece = text[low:high]
            words = (piece if _SPECIAL in piece else piece.lower()).split()  # bytes.lower() is for A-Z only
            packed = list(map(self.words.young.get, words))
            if None in packed:
                for i, ids in enumerate(packed):
                    if ids is None:
                        packed[i] = self.words.get(words[i])
                        if packed[i] is None:
                            packed[i] = self._word(words[i])
                            self.words.put(words[i], packed[i])
            found.append(b"".join(packed))
            low = high
        return np.frombuffer(b"".join(found), dtype=self.width)


_loaded: dict[tuple[str, int], WordTokenizer] = {}


def word_tokenizer(path: str, remembered: int = REMEMBERED) -> WordTokenizer:
    """One per Python worker, file and number of remembered words."""
    if (path, remembered) not in _loaded:
        _loaded[path, remembered] = WordTokenizer(path, remembered)
    return _loaded[path, remembered]
