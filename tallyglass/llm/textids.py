"""Token ids of whole texts by the tokenizers library, with a memo of text units.

A text is cut at the tokenizer's special strings, as they stand in it, which have an id of their own, and at blanks
where the tokenizer's own pre-tokenizer is bound to cut too, so the ids of the units, joined, are the ids of the text.
Units repeat, and the memo spares the library all but the first of each.
"""

from __future__ import annotations

import re
import string
import sys
from array import array

from tallyglass.llm.common import kept

MEMO_UNITS = 500_000
LINE_UNITS = 50_000
MEMO_CHARS = 64
# A run of these behind letters is a pre-token of its own in both kinds of vocabulary. An apostrophe may start a suffix.
PUNCTUATION = string.punctuation.replace("'", "")


def load_tokenizer(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # ``Specials`` has cut them out; lower-casing must not make new ones
    return tokenizer


def is_latin(text: str) -> bool:
    """Whether no character is above U+00FF; the codec looks at them many times as fast as ``max``."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Specials:
    """The special strings of a tokenizer and their ids; the texts between them are tokenized each by itself."""

    def __init__(self, tokenizer):
        added = tokenizer.get_added_tokens_decoder()
        self.ids = {t.content: packed([i]) for i, t in added.items() if t.special}
        longest_first = sorted(self.ids, key=len, reverse=True)
        self.mark = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if self.ids else None

    def cut(self, text: str) -> list[str] | None:
        """Texts and special strings in turn, or None if there is no special string."""
        return self.mark.split(text) if self.mark and self.mark.search(text) else None

    def join(self, parts: list[str], ids) -> bytes:
        return b"".join(self.ids[p] if i % 2 else ids(p) for i, p in enumerate(parts) if p)


def byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: printable bytes for themselves,
    the others, in order, for the characters from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


def packed(ids: list[int]) -> bytes:
    if sys.byteorder == "little":
        return array("I", ids).tobytes()
    out = array("I", ids)
    out.byteswap()
    return out.tobytes()


class Memo(dict):
    """Unit -> ids as little-endian unsigned 32-bit numbers. Long units are not kept.

    Half of ``most`` (``MEMO_UNITS``) are the recent ones; when these are full, they replace the older half, from which
    a unit that is asked for again comes back.

    A word of letters with some ASCII punctuation behind it is two pre-tokens in both kinds of vocabulary. The library's
    model takes such a word at once; all else goes through the whole tokenizer.
    """

    def __init__(self, tokenizer, prefix: str, lower: bool = False, most: int | None = None):
        super().__init__()
        self.tokenizer, self.tokens, self.prefix, self.lower = tokenizer, tokenizer.model.tokenize, prefix, lower
        self.most = most or MEMO_UNITS
        self.letters, self.tails, self.older = byte_letters(), {}, {}
        self.lead = prefix.translate(self.letters)

    def encode(self, text: str) -> bytes:
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def word(self, word: str) -> bytes:
        if self.lower:
            if max(word) > "\xff":  # may change under normalisation
                return self.encode(word)
            word = word.lower()
        if word.isascii():  # letters stand for themselves
            return packed([t.id for t in self.tokens(self.lead + word)])
        piece = (self.prefix + word).encode().decode("latin-1").translate(self.letters)
        return packed([t.id for t in self.tokens(piece)])

    def __missing__(self, unit: str) -> bytes:
        out = self.older.get(unit)
        if out is None:
            out = self.word(unit) if unit.isalpha() else self.pointed(unit)
        if len(unit) <= MEMO_CHARS:
            if len(self) >= self.most // 2:
                self.older = dict(self)
                self.clear()
            self[unit] = out
        return out

    def pointed(self, unit: str) -> bytes:
        """Ids of a unit that is not letters only."""
        word = unit.rstrip(PUNCTUATION)
        if not word.isalpha():
            return self.encode(self.prefix + unit)
        tail = unit[len(word) :]
        if tail not in self.tails:
            if len(self.tails) > 10_000:
                self.tails.clear()
            self.tails[tail] = self.encode(tail)
        return self[word] + self.tails[tail]


class SpacedUnits:
    """For byte-level tokenizers whose words carry their leading blank.

    A blank between two non-blank characters always starts a word. Texts with other runs of white space at a
    blank go to the library whole.
    """

    mixed = re.compile(r"\s[ ]|[ ]\s")
    breaks = re.compile(r"(?<=\S)\n(?=\S)")

    def __init__(self, path: str):
        tokenizer = load_tokenizer(path)
        self.specials = Specials(tokenizer)
        # Whole lines and the first units of lines are few among all units.
        few = min(LINE_UNITS, MEMO_UNITS)
        self.whole, self.first, self.rest = Memo(tokenizer, "", most=few), Memo(tokenizer, "", most=few), Memo(tokenizer, " ")

    def ids(self, text: str) -> bytes:
        parts = self.specials.cut(text)
        return self._plain(text) if parts is None else self.specials.join(parts, self._plain)

    def _plain(self, text: str) -> bytes:
        out = []
        lines = text.split("\n")
        if len(lines) > 1 and not all(line and not line[0].isspace() and not line[-1].isspace() for line in lines):
            lines = self.breaks.split(text)
        for i, line in enumerate(lines):
            if i:
                out.append(self.whole["\n"])
            # Without other white space than blanks, only a double blank needs care.
            mixed = "  " in line if line.isprintable() else self.mixed.search(line)
            if mixed or line[:1].isspace() or line[-1:].isspace():
                out.append(self.whole[line])
                continue
            units = line.split(" ")
            out.append(self.first[units[0]])
            out.extend(map(self.rest.__getitem__, units[1:]))
        return b"".join(out)


class BareUnits:
    """For tokenizers that drop white space: blanks and line ends only separate."""

    def __init__(self, path: str):
        tokenizer = load_tokenizer(path)
        self.specials = Specials(tokenizer)
        self.memo = Memo(tokenizer, "", lower=True)

    def ids(self, text: str) -> bytes:
        parts = self.specials.cut(text)
        return self._plain(text) if parts is None else self.specials.join(parts, self._plain)

    def _plain(self, text: str) -> bytes:
        text = text.replace("\n", " ")
        if text.isascii() or is_latin(text):
            text = text.lower()  # as the tokenizer does; one memo entry for all spellings
        return b"".join(map(self.memo.__getitem__, text.split(" ")))


def units_of(kind: type, path: str):
    """One tokenizer and memo per Python worker."""
    return kept((kind.__name__, path), lambda: kind(path))
