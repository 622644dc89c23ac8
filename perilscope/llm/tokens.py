"""Token ids of whole texts by a public vocabulary file, inside Arrow tasks.

The files' pre-tokenizers never join what stands on both sides of a word boundary, so a text is cut
there, each distinct chunk is encoded once per worker, and the ids of a text are the joined ids of
its chunks (checked against encoding whole texts in the tests).  A chunk of letters with closing
marks is two pieces to the pre-tokenizer; its letters go to the vocabulary's model directly.  The
file's added tokens (as ``<|endoftext|>``) are found in the raw text first, as the tokenizer does,
and what stands between them is cut on its own.
"""

from __future__ import annotations

import os
import re
import sys
from array import array

# the white space of the tokenizers' patterns
_WS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: byte-level pattern, words not cut further: an optional blank with a word, or white space that
#: leaves its last character to the word behind it
_BYTE_CHUNKS = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
CACHE_ENTRIES = 300_000
#: marks that always part from the letters before them and, as a run, are one piece
_MARKS = ".,;:!?#$%&*)]}@^~+=_/-"


def _byte_letters() -> dict[int, str]:
    """The printable character that byte-level vocabularies use for each byte: its own if it is
    printable in Latin-1, else the next of those from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = (b for b in range(256) if b not in own)
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def _bytes(ids: list[int]) -> bytes:
    data = array("I", ids)
    if sys.byteorder == "big":
        data.byteswap()
    return data.tobytes()


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers.

    ``lower_words``: the vocabulary drops white space (word ends are marked), else it is byte-level
    and keeps it.  The cache holds two generations of at most ``entries`` chunks, so memory is
    bounded whatever the corpus.
    """

    def __init__(self, path: str, lower_words: bool, entries: int = CACHE_ENTRIES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added):
            raise ValueError(f"{path}: added tokens that depend on the text around them")
        self.added = [t.content for t in added]
        longest = sorted(self.added, key=len, reverse=True)
        self.parts = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.blank = self.letters[0x20]
        self.lower_words, self.entries = lower_words, entries
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def chunks(self, text: str) -> list[str]:
        if any(t in text for t in self.added):
            return [c for i, part in enumerate(self.parts.split(text)) for c in ([part] if i % 2 else self._cut(part))]
        return self._cut(text)

    def _cut(self, text: str) -> list[str]:
        return text.replace("\n", " ").split(" ") if self.lower_words else _BYTE_CHUNKS.findall(text)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        cut = [self.chunks(t) if t else [] for t in texts]
        young, old = self.young, self.old
        if len(young) > self.entries:
            old, young = young, {}
            self.young, self.old = young, old
        missing = []
        for w in set().union(*cut).difference(young):
            if (ids := old.get(w)) is None:
                missing.append(w)
            else:
                young[w] = ids
        self._learn(missing)
        get = young.__getitem__
        return [b"".join(map(get, words)) for words in cut]

    def _learn(self, missing: list[str]) -> None:
        young, old, other, tails = self.young, self.old, [], {}
        lower, blank, letters, tokenize = self.lower_words, self.blank, self.letters, self.model.tokenize
        for w in missing:
            body = w.rstrip(_MARKS)
            lead = body[:1] == " "
            core = body[1:] if lead else body
            # letters of one piece; for lower-cased vocabularies only those whose case is plain
            if not core.isalpha() or (lower and not core.isascii() and max(core) > "\xff"):
                other.append(w)
                continue
            if body is w or len(body) == len(w):
                ids = None
            elif (ids := young.get(body)) is None and (ids := old.get(body)) is not None:
                young[body] = ids
            if ids is None:
                if lower:
                    core = core.lower()
                if core.isascii():
                    mapped = blank + core if lead else core
                else:
                    mapped = (" " + core if lead else core).encode().decode("latin-1").translate(letters)
                ids = young[body] = _bytes([t.id for t in tokenize(mapped)])
            if len(body) != len(w):
                tail = w[len(body):]
                if (end := tails.get(tail)) is None:
                    end = tails[tail] = _bytes(self.tokenizer.encode(tail, add_special_tokens=False).ids)
                young[w] = ids + end
        for w, e in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False)):
            young[w] = _bytes(e.ids)


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, lower_words: bool) -> Encoder:
    """The worker's encoder for a file; reused by later tasks of the same Python worker."""
    key = (path, lower_words)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, lower_words)
    return _ENCODERS[key]


def slices(texts: list[str | None], chars: int = 2_000_000):
    """(from, to) runs of texts of about ``chars`` characters, one text at least."""
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= chars:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)
