"""Token ids of whole texts by the tokenizers library, with a per-worker cache of the pieces between blanks.

Two kinds of tokenizer are recognised from their file, in which a single blank always ends a piece:
lower-cased words without white space, and byte-level BPE whose pieces take one leading blank. Plain
words go to the library's BPE model, other pieces to its whole encoder. Texts of ASCII and Latin-1 letters are
cut by the pattern of the lower-casing kind, so each word is made once, whatever its case and the signs after
it. ``encode_rows`` does so for many texts at once, for both kinds: numpy finds the pieces in the bytes of some
megabytes of texts, Arrow numbers the different ones, and only those are asked of the cache. A text (or tokenizer) for which the cut is not safe is encoded as a whole. Added tokens in a text part it into sections, which the library
encodes one by one; where an added token takes white space or the like, the text stays whole. Ids equal those of
``Tokenizer.from_file(path).encode(text, add_special_tokens=False)``.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from cinespark.llm.common import shards, utf8_list

#: ASCII and Latin-1 letters, then ASCII punctuation other than the apostrophe.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]*)")
#: Texts of these characters are cut by _PIECES, once lower-cased, as the library does by _PATTERN.
_SIMPLE = re.compile("[\t\n\r -~À-ÖØ-öø-ÿ]*")
_PIECES = re.compile("[a-zß-öø-ÿ]+|[0-9]|'(?:[stmd]|re|ve|ll)|[!-/:-@\\[-`{-~]+")
#: Bytes of texts of _SIMPLE characters: the end of a text, others, then white space, letters, digits and signs.
#: Letters beyond ASCII are byte C3 and one more there, which is not 97 or B7 (signs of multiplication and division).
_STOP, _OTHER, _SPACE, _LETTER, _DIGIT, _SIGN = range(6)
_KINDS = np.full(256, _OTHER, np.uint8)
_KINDS[33:127], _KINDS[48:58], _KINDS[65:91], _KINDS[97:123] = _SIGN, _DIGIT, _LETTER, _LETTER
_KINDS[128:192], _KINDS[[0x97, 0xB7]], _KINDS[0xC3] = _LETTER, _OTHER, _LETTER
_KINDS[[9, 10, 13, 32]], _KINDS[0] = _SPACE, _STOP
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _lowered(buf: np.ndarray) -> np.ndarray:
    """The bytes of _SIMPLE texts in lower case."""
    upper = (buf - np.uint8(65) < 26) | (buf - np.uint8(0x80) < 31) & (np.append(np.uint8(0), buf[:-1]) == 0xC3)
    return buf + upper.view(np.uint8) * np.uint8(32)


def _starts(buf: np.ndarray, kinds: np.ndarray, blank: bool) -> np.ndarray:
    """Starts of the pieces of _SIMPLE texts with a zero byte after each, in which every byte is in a piece.

    With ``blank`` as byte-level BPE cuts them: a piece takes one blank before it, digits stay together. Else as
    _PATTERN does: each digit is a piece, and white space, which that drops, is a piece here."""
    edge = np.ones(len(buf), bool)
    np.not_equal(kinds[1:], kinds[:-1], out=edge[1:])
    edge |= kinds == (_STOP if blank else _DIGIT)
    if blank:
        last = np.flatnonzero(edge[1:] & (kinds[:-1] == _SPACE) & (kinds[1:] != _STOP))      # before a piece of another kind
        edge[last] = True
        edge[last[buf[last] == 32] + 1] = False
    else:
        edge |= kinds == _STOP
    mark = np.flatnonzero((buf[:-1] == 39) & edge[:-1] & (kinds[1:] == _LETTER))             # an apostrophe alone, then letters
    one, two = buf[mark + 1], buf[np.minimum(mark + 2, len(buf) - 1)]
    short = mark[np.isin(one, list(b"stmd"))]
    long = mark[(one == ord("r")) & (two == ord("e")) | (one == ord("v")) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))]
    edge[short + 1] = edge[long + 1] = False
    edge[short + 2] = edge[long + 3] = True
    return np.flatnonzero(edge)


class _Unsafe(Exception):
    """White space at the edge of a piece."""


#: Bytes of texts that ``encode_rows`` cuts at once.
CHUNK = 4 << 20


class _Cache(dict):
    """At most ``limit`` values: when half are new, the older half goes, but for those asked again."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.half, self.older = make, max(1, limit // 2), {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def _byte_chars() -> list[str]:
    """The visible character that byte-level BPE uses for each byte."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [""] * 256, 256
    for b in range(256):
        if b in visible:
            out[b] = chr(b)
        else:
            out[b], spare = chr(spare), spare + 1
    return out


class Encoder:
    """``encode(text)``: ids as little-endian bytes of ``dtype`` (16 bits where the vocabulary allows)."""

    def __init__(self, path: str, limit: int = 400_000):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.size = self.tok.get_vocab_size(with_added_tokens=True)
        self.code = "H" if self.size <= 1 << 16 else "I"
        self.dtype = np.dtype("<u2" if self.code == "H" else "<u4")
        self.model = self.tok.model
        chars = _byte_chars()
        self.table = {b: chars[b] for b in range(256)}
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.kind = self._kind(spec)
        self.cut = self.kind == "word" and spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] == _PATTERN
        self.added = [t["content"] for t in spec.get("added_tokens") or []]
        plain = not any(t.get(f) for t in spec.get("added_tokens") or [] for f in ("lstrip", "rstrip", "single_word", "normalized"))
        self.apart = {t: self._pack([self.tok.token_to_id(t)]) for t in self.added} if plain else {}
        self.sections = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")")
        self.folded = [t["content"].lower() for t in spec.get("added_tokens") or [] if t.get("normalized")]
        # pieces after a blank, or all pieces of the word kind; bare words: of one cache where a piece alone has the same ids
        self.words = _Cache(self._word, 2 * limit if self.cut else limit)
        self.bare = self.words if self.cut else _Cache(lambda w: self._letters(w, ""), limit)
        self.first = _Cache(self._first, 50_000)
        self.pieces = self.bare if self.cut else _Cache(self._piece, limit)

    @staticmethod
    def _kind(spec: dict) -> str:
        split, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        if split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space") and norm is None:
            return "byte"
        kinds = [x.get("type") for x in (norm or {}).get("normalizers", [])]
        steps = split.get("pretokenizers", [])
        if (kinds == ["NFC", "Replace", "Lowercase"] and [x.get("type") for x in steps] == ["Split", "ByteLevel"]
                and r"[^\s\p{L}\p{N}]+" in (steps[0].get("pattern") or {}).get("Regex", "") and (spec["model"].get("end_of_word_suffix") or "")):
            return "word"
        return "whole"

    def _pack(self, ids) -> bytes:
        return array(self.code, ids).tobytes()

    def _whole(self, text: str) -> bytes:
        return self._pack(self.tok.encode(text, add_special_tokens=False).ids)

    def _letters(self, word: str, before: str) -> bytes:
        """A run of letters, which is one piece for the model."""
        if word.isascii():                                           # letters stand for themselves
            form = self.table[32] + word if before else word
        else:
            form = (before + word).encode().decode("latin-1").translate(self.table)
        return self._pack([t.id for t in self.model.tokenize(form)])

    def _tail(self, tail: str) -> bytes:
        return self.first[tail] if tail else b""

    def _first(self, piece: str) -> bytes:
        """A piece without a blank before it."""
        return self._whole(piece)

    def _word(self, piece: str) -> bytes:
        if not piece:
            return b""
        plain = _PLAIN.fullmatch(piece)
        if self.kind == "word":
            if plain:
                low = plain[1].lower()
                return self._letters(low, "") if low == piece else self.bare[low] + self._tail(plain[2])
            if "\n" in piece:
                return b"".join([self.words[x] for x in piece.split("\n")])
            return self._whole(piece)
        if plain:
            return self.words[plain[1]] + self._tail(plain[2]) if plain[2] else self._letters(piece, " ")
        if piece[0].isspace() or piece[-1].isspace():
            raise _Unsafe
        lines = piece.split("\n")
        if len(lines) > 1 and all(lines) and not any(x[0].isspace() or x[-1].isspace() for x in lines):
            return self.words[lines[0]] + b"".join([self._first_line("\n" + x) for x in lines[1:]])
        return self._whole(" " + piece)

    def _piece(self, piece: str) -> bytes:
        """A piece of the byte kind, with the blank before it."""
        if piece.isascii() and piece.isprintable():
            form = piece.replace(" ", self.table[32])
        else:
            form = piece.encode().decode("latin-1").translate(self.table)
        return self._pack([t.id for t in self.model.tokenize(form)])

    def _first_line(self, line: str) -> bytes:
        """A line feed and the piece after it."""
        plain = _PLAIN.fullmatch(line[1:])
        if plain:
            return self.first["\n"] + self.bare[plain[1]] + self._tail(plain[2])
        return self._whole(line)

    def _section(self, text: str) -> bytes:
        """A text without added tokens."""
        if self.cut and _SIMPLE.fullmatch(text):
            return b"".join(map(self.bare.__getitem__, _PIECES.findall(text.lower())))
        parts = text.split(" ")
        if self.kind == "word":
            return b"".join(map(self.words.__getitem__, parts))
        tail = b""
        if len(parts) > 1 and not parts[-1]:                        # one blank at the end is a piece of its own
            parts.pop()
            tail = self.first[" "]
        head = parts[0]
        if "" in parts[1:] or not head and len(parts) == 1 or tail and parts[-1][-1:].isspace():
            return self._whole(text)
        try:
            if head and (head[0].isspace() or head[-1].isspace()):
                return self._whole(text)
            return (self.first[head] if head else b"") + b"".join(map(self.words.__getitem__, parts[1:])) + tail
        except _Unsafe:
            return self._whole(text)

    def encode(self, text: str) -> bytes:
        if self.kind == "whole" or self.folded and any(t in text.lower() for t in self.folded):
            return self._whole(text)
        if not any(t in text for t in self.added):
            return self._section(text)
        if not self.apart:
            return self._whole(text)
        return b"".join([self.apart[x] if x in self.apart else self._section(x) for x in self.sections.split(text) if x])

    def encode_rows(self, column: pa.Array):
        """(first row, ids of that row and the next ones as an array of ``encode``'s bytes), for a column of texts; null is empty."""
        texts = utf8_list(column)
        for first, end in shards(texts, CHUNK):
            yield first, self._chunk(texts[first:end])

    def _chunk(self, texts: list[bytes]) -> pa.Array:
        if not self.cut and self.kind != "byte" or self.folded:
            return pa.array([self.encode(t.decode()) for t in texts], pa.binary())
        marks = [t.encode() for t in self.added]
        apart = {i: t for i, t in enumerate(texts) if any(m in t for m in marks)}
        buf, kinds, odd = self._buffer([b"" if i in apart else t for i, t in enumerate(texts)] if apart else texts)
        if len(odd):                                                 # texts of other characters, one by one
            apart.update((i, texts[i]) for i in odd.tolist())
            buf, kinds, _ = self._buffer([b"" if i in apart else t for i, t in enumerate(texts)])
        if self.cut:
            buf = _lowered(buf)
        starts = _starts(buf, kinds, not self.cut)
        ends = np.flatnonzero(kinds[starts] == _STOP)
        offsets = np.append(starts, len(buf)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(buf)]).dictionary_encode()
        names = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        names[names.index("\0")] = ""
        blobs = pa.array(list(map(self.pieces.__getitem__, names)), pa.binary()).take(pieces.indices)
        _, offsets, data = blobs.buffers()
        offsets = np.append(np.int32(0), np.frombuffer(offsets, np.int32)[ends])
        out = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(offsets), data])
        if not apart:
            return out
        return pc.replace_with_mask(out, pa.array(np.isin(np.arange(len(texts)), list(apart))),
                                    pa.array([self.encode(apart[i].decode()) for i in sorted(apart)], pa.binary()))

    @staticmethod
    def _buffer(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The texts with a zero byte after each, the kinds of the bytes, and the numbers of texts that hold others."""
        buf = np.frombuffer(b"\0".join([*texts, b""]), np.uint8)
        kinds = _KINDS[buf]
        odd = np.flatnonzero(kinds <= _OTHER)                        # one is the end of the text
        if len(odd) == len(texts):
            return buf, kinds, odd[:0]
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        return buf, kinds, np.flatnonzero(np.bincount(np.searchsorted(ends, odd, "right"), minlength=len(texts)) > 1)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
