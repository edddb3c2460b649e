"""Token ids of whole texts with a public tokenizer, word by word through a bounded cache."""

from __future__ import annotations

import re
from array import array
from collections.abc import Sequence

from tokenizers import Tokenizer, pre_tokenizers

from probity.llm.scratch import kept

#: Words that a worker keeps; after as many more unknown ones it begins anew.
CACHED_WORDS = 500_000
#: Places for words that were met once, by their hash.
SEEN_ONCE = 1 << 22
#: Longer words are encoded each time.
LONGEST_CACHED = 40

# White space other than single spaces and line breaks, and what some rules count as such.
_ODD = re.compile(
    "[\\x00-\\x09\\x0b-\\x1f\\x7f-\\xa0\\u1680\\u180e\\u2000-\\u200f\\u2028-\\u202f"
    "\\u205f-\\u206f\\u3000\\ufeff]"
)
_RUNS = ("  ", " \n", "\n ", "\n\n")
_FIRST = "\r"
# A word of letters, maybe after a line break, and maybe one mark behind it: a piece each.
_SIMPLE = re.compile("([\n\r]?)([A-Za-zÀ-ÖØ-öø-ɏ]+)([.,;:!?]?)")


def _words(text: str) -> list[str] | None:
    """The text cut before each space and line break; None if it has other white space or runs.

    A byte-level vocabulary ends a piece before white space, and a single space
    or line break depends on nothing before it, so such cuts change no id. A word
    stands for itself with a space before it, unless it begins with a line break
    or with the mark of the first word.
    """
    if any(run in text for run in _RUNS) or _ODD.search(text):
        return None
    return (_FIRST + text.replace("\n", " \n")).split(" ")


def _whole(word: str) -> str:
    return word[1:] if word[0:1] == _FIRST else word if word[0:1] == "\n" else " " + word


class Encoder:
    """Encodes texts to unsigned 32-bit ids, least byte first.

    The ids are those that the tokenizer gives for the whole text. With ``special``
    the strings of special tokens are these tokens, as is the library's default;
    without, they count as ordinary text.
    """

    def __init__(self, path: str, special: bool = True) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        added = self.tokenizer.get_added_tokens_decoder().values()
        #: Strings that cuts before white space might miss: texts with one are encoded whole.
        self._added = [t.content for t in added if special or not t.special]
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self._model = self.tokenizer.model
        # How the vocabulary writes each byte, asked from the library; cuts need such a vocabulary.
        self._byte_level = isinstance(self.tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel)
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        latin = {b: spell(chr(b))[0][0] for b in range(128)}
        for first in range(0xC3, 0xCA):  # the letters of _SIMPLE
            for second in range(0x80, 0xC0):
                written = spell(bytes([first, second]).decode())[0][0]
                latin[first], latin[second] = written
        self._spelling, self._space = latin, latin[32]
        self._marks = {m: self._plain(m) for m in ".,;:!?\n"} | {"": b"", _FIRST: b""}
        self._known: dict[str, bytes] = {}
        self._missed = 0
        self._seen = bytearray(SEEN_ONCE)

    def _plain(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def _encode(self, word: str) -> bytes:
        simple = _SIMPLE.fullmatch(word)
        if not simple:
            return self._plain(_whole(word))
        begin, letters, end = simple.groups()
        if not letters.isascii():
            letters = letters.encode().decode("latin1").translate(self._spelling)
        if not begin:
            letters = self._space + letters
        ids = array("I", [t.id for t in self._model.tokenize(letters)]).tobytes()
        return self._marks[begin] + ids + self._marks[end] if begin or end else ids

    def _new(self, words: Sequence[str]) -> dict[str, bytes]:
        """The ids of words that aren't known; those met before are from now on, if there is room."""
        if self._missed > CACHED_WORDS:  # the texts have changed: learn their words
            self._known, self._missed = {}, 0
        known, seen, found = self._known, self._seen, {}
        for w in words:
            if w in found:
                continue
            found[w] = self._encode(w)
            place = hash(w) % SEEN_ONCE
            if not seen[place]:  # most words of a language are met once only
                seen[place] = 1
            elif len(known) >= CACHED_WORDS:
                self._missed += 1
            elif len(w) <= LONGEST_CACHED:
                known[w] = found[w]
        return found

    def __call__(self, text: str | None) -> bytes:
        """The ids of a text; NULL and the empty text have none."""
        if not text:
            return b""
        whole = not self._byte_level or any(t in text for t in self._added)
        words = None if whole else _words(text)
        if words is None:
            return self._plain(text)
        ids = list(map(self._known.get, words))
        if None in ids:
            found = self._new([w for w, own in zip(words, ids, strict=True) if own is None])
            ids = [found[w] if own is None else own for w, own in zip(words, ids, strict=True)]
        return b"".join(ids)


def encoder(path: str, special: bool = True) -> Encoder:
    """The worker's encoder of this vocabulary and way with special tokens."""
    return kept((path, special), lambda: Encoder(path, special))
