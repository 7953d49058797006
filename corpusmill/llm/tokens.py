"""Token ids of whole texts by a public tokenizer, fast on repeated words.

Byte-pair merges never cross the boundary of a pre-token, so the ids of a text
are the ids of its pre-tokens in a row. :class:`WordCache` finds the boundaries of
a whole batch with array operations on the UTF-8 bytes, lists each distinct
pre-token once and remembers its ids; only one not seen before goes through the
library's merge model. Texts where this split could differ from the library's own
(letters beyond Latin, special tokens, rare control characters) are encoded by the
library as a whole.
"""

from __future__ import annotations

import unicodedata
from array import array
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pre-tokens remembered by one worker since the last turn; as many of the turn before stay.
CACHE_WORDS = 250_000
#: Pre-tokens longer than this are encoded but not remembered.
CACHE_CHARS = 64
#: Bytes of text that are split at a time; longer texts are cut, where no token can cross.
SLICE_BYTES = 2 << 20
#: Texts that the shortcut leaves to the library: code points from 0x180, control
#: characters and blanks that not every pattern takes alike, the capital I with a dot
#: (it has two code points in lower case) and what may begin a special token.
_LIBRARY = r"[^\x00-\x{17F}]|[\x1C-\x1F\x{85}\x{A0}\x{130}]|<\|"

_LETTER, _NUMBER, _OTHER, _SPACE = range(4)


def _class_of(c: int) -> int:
    if chr(c) in "\t\n\x0b\x0c\r ":
        return _SPACE
    return {"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(chr(c))[0], _OTHER)


#: Class of each code point below 0x180.
_CLASSES = np.array([_class_of(c) for c in range(0x180)], dtype=np.uint8)


def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others follow from code point 256."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def char_classes(data: np.ndarray) -> np.ndarray:
    """The class of the character that each UTF-8 byte belongs to."""
    out = _CLASSES[np.where(data < 0x80, data, 0)]
    lead = np.flatnonzero(data >= 0xC2)
    if len(lead):
        out[lead] = out[lead + 1] = _CLASSES[(data[lead].astype(np.intp) & 0x1F) << 6 | data[lead + 1] & 0x3F]
    return out


def pretoken_starts(data: np.ndarray, firsts: np.ndarray, blank_leads: bool) -> np.ndarray:
    """Where pre-tokens begin in the bytes of several texts that begin at ``firsts``.

    Runs of letters, of numbers, of other marks, and of white space. With
    ``blank_leads`` a blank belongs to the run after it, and white space before
    another run ends one character early; without, every number stands alone.
    An apostrophe that begins a run makes a token with s, t, m, d, re, ve or ll.
    """
    n = len(data)
    kind = char_classes(data)
    begins = np.zeros(n + 1, dtype=bool)
    begins[firsts] = True
    begins[n] = True
    start = np.empty(n + 1, dtype=bool)
    start[0] = start[n] = True
    np.not_equal(kind[1:], kind[:-1], out=start[1:n])
    space = kind == _SPACE
    if blank_leads:
        before_run = np.zeros(n, dtype=bool)  # last of its white space, and a run of the same text follows
        before_run[:-1] = space[:-1] & ~space[1:]
        before_run &= ~begins[1:]
        led = np.zeros(n + 1, dtype=bool)
        led[1:n] = before_run[:-1] & (data[:-1] == 0x20)
        start[:n] |= before_run
        start &= ~led
    else:
        start[:n] |= (kind == _NUMBER) & (data & 0xC0 != 0x80)
    start |= begins
    at = np.flatnonzero(data == 0x27)
    at = at[start[at]]
    if len(at):
        padded = np.concatenate([data, np.zeros(3, dtype=np.uint8)])
        inside = ~begins[np.minimum(at + 1, n)]
        one, two = padded[at + 1], padded[at + 2]
        short = inside & np.isin(one, np.frombuffer(b"stmd", dtype=np.uint8))
        same_text = ~begins[np.minimum(at + 2, n)]
        long = inside & same_text & (np.isin(one, np.frombuffer(b"rv", dtype=np.uint8)) & (two == 0x65) | (one == 0x6C) & (two == 0x6C))
        for hit, size in ((short, 2), (long & ~short, 3)):
            start[at[hit] + 1] = False
            start[at[hit] + size] = True
    return np.flatnonzero(start[:n])


def safe_cuts(data: np.ndarray, size: int) -> list[int]:
    """Places about ``size`` bytes apart where a blank stands between two bytes that are
    no white space: a pre-token begins there, whatever the pattern."""
    cuts, at = [], size
    while at < len(data) - 1:
        window = data[at - 1 : at + 4096]
        space = _CLASSES[np.minimum(window, 0x7F)] == _SPACE
        hit = np.flatnonzero((window[1:-1] == 0x20) & ~space[:-2] & ~space[2:])
        if len(hit):
            cuts.append(at + int(hit[0]))
            at = cuts[-1] + size
        else:
            at += 4000
    return cuts


class WordCache:
    """Ids by one tokenizer file; ``code`` is ``H`` or ``I``, the width it keeps them in."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        #: White space is no part of tokens and case is dropped.
        self.lower = self.library.normalizer is not None
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.code = "H" if self.library.get_vocab_size() <= 1 << 16 else "I"
        self.table = str.maketrans({chr(b): c for b, c in byte_alphabet().items()})

    def _word(self, word: str) -> bytes:
        out = self.older.get(word)
        if out is None:
            if self.lower and word.isspace():
                out = b""
            else:
                stand_ins = word.encode().decode("latin-1").translate(self.table)
                out = array(self.code, [t.id for t in self.model.tokenize(stand_ins)]).tobytes()
        if len(word) <= CACHE_CHARS:
            if len(self.known) >= CACHE_WORDS:
                self.older, self.known = self.known, {}
            self.known[word] = out
        return out

    def _split(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that the shortcut holds for, and how many each has."""
        if self.lower:
            texts = pc.utf8_lower(texts)
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1]
        lo, hi = int(offsets[0]), int(offsets[-1])
        if hi == lo:
            return np.zeros(0, dtype=np.uint32), np.zeros(len(texts), dtype=np.int64)
        data, offsets = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[lo:hi], offsets - lo
        if len(texts) > 1 or hi - lo <= 2 * SLICE_BYTES:
            return self._split_bytes(data, offsets)
        cuts = [0, *safe_cuts(data, SLICE_BYTES), len(data)]
        parts = [self._split_bytes(data[i:j], np.array([0, j - i]))[0] for i, j in zip(cuts, cuts[1:])]
        return np.concatenate(parts), np.array([sum(map(len, parts))])

    def _split_bytes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        firsts = offsets[:-1][np.diff(offsets) > 0]
        starts = pretoken_starts(data, firsts, not self.lower).astype(np.int32)
        bounds = pa.py_buffer(np.append(starts, np.int32(len(data))))
        words = pa.StringArray.from_buffers(len(starts), bounds, pa.py_buffer(data)).dictionary_encode()
        known, word_ids, width = self.known, self._word, 2 if self.code == "H" else 4
        found = []
        for word in words.dictionary.to_pylist():
            ids = known.get(word)
            if ids is None:
                ids = word_ids(word)
                known = self.known
            found.append(ids)
        sizes = np.array([len(f) for f in found], dtype=np.int64) // width
        flat = np.frombuffer(b"".join(found), dtype=f"<u{width}")
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat))
        ids = lists.take(words.indices).flatten().to_numpy().astype(np.uint32)
        upto = np.concatenate([[0], np.cumsum(sizes[words.indices.to_numpy()])])
        return ids, np.diff(upto[np.searchsorted(starts, offsets)])

    def _library_ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def batches(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids one text after the other, ids of each text) for slices of the texts, in order."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        sizes = pc.binary_length(texts).to_numpy()
        turn = np.cumsum(sizes) // SLICE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(turn)) + 1).tolist(), len(texts)]
        for lo, hi in zip(cuts, cuts[1:]):
            if hi > lo:
                yield self._slice(texts.slice(lo, hi - lo))

    def _slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        odd = pc.match_substring_regex(texts, _LIBRARY)
        which = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        if not len(which):
            return self._split(texts)
        plain, some = self._split(texts.filter(pc.invert(odd)))
        counts = np.zeros(len(texts), dtype=np.int64)
        whole = {int(i): self._library_ids(texts[int(i)].as_py()) for i in which}
        counts[which] = [len(whole[int(i)]) for i in which]
        counts[np.setdiff1d(np.arange(len(texts)), which)] = some
        parts, at = [], 0
        for i, n in enumerate(counts.tolist()):
            if i in whole:
                parts.append(whole[i])
            else:
                parts.append(plain[at : at + n])
                at += n
        return np.concatenate(parts), counts

    def ids(self, text: str) -> np.ndarray:
        """All ids of one text, as uint32."""
        return self._slice(pa.array([text], pa.string()))[0]


_LOADED: dict[str, WordCache] = {}


def tokenizer(path: str) -> WordCache:
    """The tokenizer of this file, loaded once in each Python worker."""
    if path not in _LOADED:
        _LOADED[path] = WordCache(path)
    return _LOADED[path]


def ids_of(path: str, batch: pa.RecordBatch, text_at: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, ids) of each text of a batch."""
    row = 0
    for ids, counts in tokenizer(path).batches(batch.column(text_at)):
        at = 0
        for n in counts.tolist():
            yield row, ids[at : at + n]
            row, at = row + 1, at + n


def public_path(name: str) -> str:
    """Where a public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
