"""Token ids by the ``tokenizers`` library, as little-endian bytes.

A BPE tokenizer cuts a text into pieces by a pattern before it merges anything, and the ids of a text are
those of its pieces, one after the other. Pieces recur: many texts are cut at once with numpy, equal pieces
are found with Arrow, and only pieces that the worker has not met are given to the library's merge model. The
pieces that it has met are an Arrow array as well, so that no string is made of a piece that it knows.

That is done for the two patterns below, and for texts of characters about whose class all versions of
Unicode agree. Other tokenizers, texts with other characters and texts that hold the string of a special
token are given to the library whole.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache
from unicodedata import category, normalize, ucd_3_2_0

import numpy as np
import pyarrow as pa

# When a worker has met so many pieces (some 40 bytes each), those it had not met since the last time are
# forgotten. It has at most twice so many, and those of two groups of texts.
KEPT_PIECES = 250_000
# Pieces with more bytes than this together (a few very long ones) are all forgotten.
KEPT_BYTES = 64 << 20
# Characters of text that are cut at a time.
GROUP_CHARS = 4 << 20

# How the pieces of the lower-casing tokenizer are written in its file, and the endings that
# both tokenizers cut off behind an apostrophe.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
APOSTROPHE = ord("'")

# Classes of characters. Those without one are left to the library.
LETTER, NUMBER, MARK, SPACE, BREAK = 1, 2, 3, 4, 5


def _byte_letters() -> dict[int, int]:
    """What a byte-level vocabulary writes for each byte: printable Latin-1 bytes stand for
    themselves, the others are numbered from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {b: b if b in plain else 256 + others.index(b) for b in range(256)}


BYTE_LETTERS = np.array([letter for _, letter in sorted(_byte_letters().items())], "<u2")


def _lower(text: str) -> str:
    """Character by character, so that no character looks at its neighbours."""
    return text.lower() if text.isascii() else "".join(map(str.lower, text))


@lru_cache(maxsize=2)
def character_classes(normalized: bool) -> np.ndarray:
    """The class of each character of the basic plane. With ``normalized``, none for those that composition
    or lower case can make into something of another length or class."""
    kinds = {"L": LETTER, "N": NUMBER, "M": MARK, "P": MARK, "S": MARK}
    out = np.zeros(1 << 16, np.int8)
    for code in range(1 << 16):
        c = chr(code)
        kind = category(c)[0]
        if kind not in kinds or ucd_3_2_0.category(c)[0] != kind:
            continue
        if normalized and (
            kind == "M" or 0x1100 <= code < 0x1200 or normalize("NFC", c) != c
            or len(c.lower()) != 1 or category(c.lower())[0] != kind
        ):
            continue
        out[code] = kinds[kind]
    out[ord(" ")] = SPACE
    out[[ord("\t"), ord("\n"), ord("\r")]] = BREAK
    return out


class Encoder:
    def __init__(self, path: str, plain_specials: bool = False):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.library = Tokenizer.from_file(path)
        # With plain_specials the string of a special token in a text is ordinary text.
        self.library.encode_special_tokens = plain_specials
        kind = json.loads(self.library.to_str())
        self.specials = [] if plain_specials else [t["content"] for t in kind["added_tokens"]]
        before = kind.get("pre_tokenizer") or {}
        steps = before.get("pretokenizers") or []
        normal = [n["type"] for n in (kind.get("normalizer") or {}).get("normalizers", [])]
        # A space belongs to the word behind it, or white space is dropped and capitals lowered.
        self.spaced = (
            kind.get("normalizer") is None and before.get("type") == "ByteLevel"
            and not before.get("add_prefix_space") and before.get("use_regex", True)
        )
        self.dropped = (
            normal == ["NFC", "Replace", "Lowercase"] and [s["type"] for s in steps] == ["Split", "ByteLevel"]
            and steps[0]["pattern"].get("Regex") == WORD_PATTERN
        )
        self._forget_all()

    def _forget_all(self) -> None:
        # The pieces, their ids, which of them were met since some were forgotten, and how many were left then.
        self.pieces, self.ids = pa.array([], pa.string()), pa.array([], pa.large_binary())
        self.met, self.older = np.zeros(0, bool), 0

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _new(self, pieces: pa.StringArray) -> pa.LargeBinaryArray:
        """Ids of what the library would not split."""
        if self.dropped:
            pieces = pa.array(["" if p[0].isspace() else _lower(p) for p in pieces.to_pylist()], pa.string())
        _, ends, raw = pieces.buffers()
        ends = np.frombuffer(ends, np.int32)[pieces.offset : pieces.offset + len(pieces) + 1]
        # The vocabulary is written in letters for bytes.
        raw = np.frombuffer(raw or b"", np.uint8)[ends[0] : ends[-1]]
        letters = BYTE_LETTERS[raw].tobytes().decode("utf-16-le")
        ends = (ends - ends[0]).tolist()
        tokenize, sizes, flat = self.library.model.tokenize, [0], []
        for a, b in zip(ends, ends[1:], strict=False):
            tokens = tokenize(letters[a:b]) if a < b else ()
            sizes.append(len(tokens))
            flat += [token.id for token in tokens]
        ids = np.array(flat, "<u4")
        cuts = 4 * np.cumsum(sizes, dtype=np.int64)
        return pa.Array.from_buffers(
            pa.large_binary(), len(pieces), [None, pa.py_buffer(cuts.tobytes()), pa.py_buffer(ids.tobytes())]
        )

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids, unsigned 32-bit little-endian, without special tokens added."""
        encode = self._group if self.spaced or self.dropped else self._whole
        out, group, size = [], [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size >= GROUP_CHARS:
                out += encode(group)
                group, size = [], 0
        return out + (encode(group) if group else [])

    def _group(self, texts: list[str]) -> list[bytes]:
        by_library = {k for k, t in enumerate(texts) if any(s in t for s in self.specials)}
        rest = [k for k in range(len(texts)) if k not in by_library]
        raw, begins, classes = self._classes([texts[k] for k in rest])
        if len(odd := np.flatnonzero(classes == 0)):
            unknown = set(np.unique(np.searchsorted(begins, odd, side="right") - 1).tolist())
            by_library |= {rest[k] for k in unknown}
            rest = [k for k in range(len(texts)) if k not in by_library]
            raw, begins, classes = self._classes([texts[k] for k in rest])
        out = [b""] * len(texts)
        for k, ids in zip(rest, self._by_piece(raw, begins, classes), strict=True):
            out[k] = ids
        if by_library:
            for k, ids in zip(sorted(by_library), self._whole([texts[k] for k in sorted(by_library)]), strict=True):
                out[k] = ids
        return out

    def _classes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Their bytes, where each text begins, with the end of the last, and the class of each byte."""
        known = character_classes(self.dropped)
        encoded = [t.encode() for t in texts]
        raw = np.frombuffer(b"".join(encoded), np.uint8)
        begins = np.concatenate([[0], np.cumsum([len(e) for e in encoded], dtype=np.int64)])
        first = np.zeros(256, np.int8)
        first[:128] = known[:128]
        classes = first[raw]
        two = np.flatnonzero((raw >= 0xC0) & (raw < 0xE0))
        if len(two):
            code = (raw[two] & 0x1F).astype(np.int64) << 6 | raw[two + 1] & 0x3F
            classes[two] = classes[two + 1] = known[code]
        three = np.flatnonzero((raw >= 0xE0) & (raw < 0xF0))
        if len(three):
            code = (raw[three] & 0x0F).astype(np.int64) << 12
            code |= (raw[three + 1] & 0x3F).astype(np.int64) << 6 | raw[three + 2] & 0x3F
            classes[three] = classes[three + 1] = classes[three + 2] = known[code]
        return raw, begins, classes

    def _starts(self, raw: np.ndarray, begins: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Where pieces begin."""
        edges = begins[:-1][begins[:-1] < begins[1:]]
        before = np.concatenate([[0], classes[:-1]]).astype(np.int8)
        before[edges] = 0
        white = classes >= SPACE
        # The same for both: a run of white space begins.
        starts = white & (before < SPACE)
        if self.spaced:
            starts |= ~white & (classes != before) & (before != SPACE)
            # The last of a run stands by itself, or before the word behind it.
            behind = np.concatenate([classes[1:], [0]]).astype(np.int8)
            behind[edges[1:] - 1] = 0
            starts |= white & (behind > 0) & (behind < SPACE)
        else:
            numbers = (classes == NUMBER) & ((raw & 0xC0) != 0x80)
            starts |= ~white & ((classes != before) | numbers)
        self._cut_endings(starts, raw, begins, classes)
        return starts

    def _cut_endings(self, starts: np.ndarray, raw: np.ndarray, begins: np.ndarray, classes: np.ndarray) -> None:
        at = np.flatnonzero(starts & (raw == APOSTROPHE))
        if not len(at):
            return
        room = begins[np.searchsorted(begins, at, side="right")] - at
        last = len(raw) - 1
        fold = 0x20 if self.dropped else 0
        after = [raw[np.minimum(at + k, last)] for k in (1, 2)]
        for ending in ENDINGS:
            size = 1 + len(ending)
            fits = room >= size
            for letter, byte in zip(ending, after, strict=False):
                fits &= (byte | fold if fold else byte) == ord(letter)
            cut = at[fits]
            starts[cut + 1] = False
            behind = (cut + size)[room[fits] > size]
            starts[behind[classes[behind] == LETTER]] = True

    def _by_piece(self, raw: np.ndarray, begins: np.ndarray, classes: np.ndarray) -> list[bytes]:
        if not len(raw):
            return [b""] * (len(begins) - 1)
        first = np.flatnonzero(self._starts(raw, begins, classes))
        offsets = np.append(first, len(raw)).astype(np.int32)
        pieces = pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(raw))
        rows = self._rows(pieces)
        each = self.ids.take(rows)
        _, ends, whole = each.buffers()
        ends = np.frombuffer(ends, np.int64)
        # The ids before each text.
        cuts = ends[np.searchsorted(first, begins)].tolist()
        return [whole[a:b].to_pybytes() for a, b in zip(cuts, cuts[1:], strict=False)]

    def _rows(self, pieces: pa.StringArray) -> pa.Array:
        """Where each piece stands among those that the worker knows; new ones are added to them."""
        if self.pieces.nbytes > KEPT_BYTES:
            self._forget_all()
        elif np.count_nonzero(self.met) > KEPT_PIECES:
            met = pa.array(self.met)
            self.pieces, self.ids = self.pieces.filter(met), self.ids.filter(met)
            self.older = len(self.pieces)
            self.met = np.zeros(self.older, bool)
        # Codes follow first places, so those of known pieces are where they stand.
        known = len(self.pieces)
        coded = pa.concat_arrays([self.pieces, pieces]).dictionary_encode()
        rows, every = coded.indices[known:], coded.dictionary
        if len(every) > known:
            self.ids = pa.concat_arrays([self.ids, self._new(every[known:])])
            self.met = np.append(self.met, np.ones(len(every) - known, bool))
            self.pieces = every
        self.met[rows.to_numpy()] = True
        return rows


@lru_cache(maxsize=4)
def encoder(name: str, plain_specials: bool = False) -> Encoder:
    """The worker's encoder for a tokenizer file, or for a file name of ``public_tokenizers``."""
    if not os.path.exists(name):
        import public_tokenizers

        name = public_tokenizers.path(name)
    return Encoder(name, plain_specials)
