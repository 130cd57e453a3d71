"""Token ids of whole texts by a public tokenizer, with remembered words.

A text is cut before single spaces and around single line ends that stand between
two other characters. Neither tokenizer forms a token across such a place, so the
ids of the pieces, joined, are the ids of the text (the tests compare both). Arrow
cuts the texts of a call and numbers their different pieces, each of which is looked
up once a call. Pieces are encoded once per worker and remembered up to a fixed number. The signs
that close a word are tokens of their own and are remembered
apart from it; A-Z are folded first if the tokenizer folds case itself. Letters, with or without a
space before them, that the tokenizer's normalizer and pre-tokenizer leave as one unit go
straight to its model, all other pieces through the whole tokenizer. A text
that holds the name of an added token is encoded by the library as a whole.
"""

from __future__ import annotations

import json
import re
import struct
from codecs import charmap_decode
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

#: Pieces that a worker remembers, if its encoder is not told another number. Half of them are the last learned; the other half, those before, are
#: forgotten at once unless they were met again.
REMEMBERED = 400_000

_CUTS = re.compile(r"(?<=\S)(?=[ \n]\S)|(?<=\S\n)(?=\S)")
_DOUBLE = re.compile(r"[ \n\0][\s\0]|\s[ \n\0]")
#: White space other than space and line end, by the rule of Python.
_OTHER_SPACES = [x for x in map(chr, range(0x3001)) if x.isspace() and x not in " \n"]
#: ASCII signs other than the apostrophe.
_SIGNS = "".join(x for x in map(chr, range(33, 127)) if not x.isalnum() and x != "'")
#: Latin letters; ASCII signs other than apostrophes that follow one are tokens of their own.
_LATIN = pa.array([x for x in map(chr, range(0x250)) if re.match("(?!İ)[A-Za-zÀ-ÖØ-öø-ɏ]", x)], pa.large_string())
_BEFORE_SIGNS = rf"(?s)^.*[^{re.escape(_SIGNS)}]"
#: Letters below this sign (Latin, Greek, Cyrillic) are letters for every version of Unicode in use.
_OLD_LETTERS = "\u0500"
_PROBE = " abcdefghijklmnopqrstuvwxyzßéàžλяї"


def _byte_signs() -> str:
    """The sign that stands for each byte of letters below U+0800 in byte-level vocabularies, as the library gives it."""
    cut = ByteLevel(add_prefix_space=False, use_regex=False)
    table = {}
    for number in range(0x800):
        if not 0xD800 <= number < 0xE000:
            for byte, sign in zip(chr(number).encode(), cut.pre_tokenize_str(chr(number))[0][0], strict=True):
                table[byte] = sign
    return "".join(table.get(byte, "\ufffe") for byte in range(256))


_PACKED = [struct.Struct(f"<{x}I").pack for x in range(16)]


def _packed(ids: list[int]) -> bytes:
    return _PACKED[len(ids)](*ids) if len(ids) < 16 else struct.pack(f"<{len(ids)}I", *ids)


class _Known(dict):
    """Ids of remembered pieces (by their UTF-8 bytes, which take less memory); a missing one is encoded."""

    def __init__(self, tokenizer: Tokenizer, folds: bool, before: dict[bytes, bytes]):
        self.tokenizer, self.folds, self.before = tokenizer, folds, before
        self.model = tokenizer.model
        self.signs = _byte_signs()
        self.normal = tokenizer.normalizer is None
        self.unit = self._unit_rule()

    def _unit_rule(self) -> int | None:
        """Where the unit that the model sees of a space and letters begins, None if they or the letters are not one unit."""
        text = _PROBE
        if self.tokenizer.normalizer is not None:
            text = self.tokenizer.normalizer.normalize_str(text)
        if text != _PROBE or self.tokenizer.pre_tokenizer is None:
            return None
        bare, units = (
            [x for x, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(x)] for x in (text[1:], text)
        )
        for begin in (0, 1):
            if units == [self._bytes(_PROBE[begin:])] and bare == [self._bytes(_PROBE[1:])]:
                return begin
        return None

    def _bytes(self, text: str) -> str:
        return charmap_decode(text.encode(), "strict", self.signs)[0]

    def _model_unit(self, piece: str) -> str | None:
        spaced = piece[:1] == " "
        if self.unit is None or not (piece[1:] if spaced else piece).isalpha():
            return None
        begin = self.unit if spaced else 0
        if piece.isascii():
            return self.signs[32] + piece[1:] if spaced and not begin else piece[begin:]
        if max(piece) < _OLD_LETTERS and (
            self.normal or is_normalized("NFKC", piece) and not (self.folds and piece != piece.lower())
        ):
            return self._bytes(piece[begin:])
        return None

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.before.get(piece)
        if ids is None:
            text = piece.decode()
            unit = self._model_unit(text)
            if unit is None:
                numbers = self.tokenizer.encode(text, add_special_tokens=False).ids
            else:
                numbers = [x.id for x in self.model.tokenize(unit)]
            ids = _packed(numbers)
        self[piece] = ids
        return ids


def _gathered(flat: np.ndarray, size: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat``, whose lengths are ``size``, in the order of ``index``, and where each begins, then the end."""
    runs = pa.LargeListArray.from_arrays(np.concatenate(([0], np.cumsum(size))), flat)
    taken = runs.take(pa.array(index))
    return taken.values.to_numpy(), taken.offsets.to_numpy()


class Encoder:
    """``encode(texts)`` gives each text's ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, remembered: int | None = None):
        self.remembered = remembered
        self.tokenizer = Tokenizer.from_file(path)
        self.folds = '"Lowercase"' in json.dumps(json.loads(self.tokenizer.to_str())["normalizer"])
        self.names = [x.content.lower() for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = _Known(self.tokenizer, self.folds, {})

    def _learned(self, piece: bytes) -> bytes:
        if len(self.known) > (self.remembered or REMEMBERED) // 2:
            self.known.before = {}
            self.known = _Known(self.tokenizer, self.folds, self.known)
        return self.known[piece]

    def _folded(self, text: str) -> str:
        return text.encode().lower().decode() if self.folds else text

    def _cut(self, text: str) -> str:
        """``text``, which holds no zero, with a zero at each cut."""
        text = self._folded(text)
        doubled = (
            "  " in text or " \n" in text or "\n " in text or "\n\n" in text
            or any(x in text for x in _OTHER_SPACES) and _DOUBLE.search(text)
        )
        if doubled:
            return "\0".join(_CUTS.split(text))
        return text.replace(" ", "\0 ").replace("\n", "\0\n\0")

    def _apart(self, text: str) -> bytes | None:
        """The ids of a text that holds a zero or the name of an added token, None for any other."""
        if "<" in text and any(name in text.lower() for name in self.names):
            return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if "\0" in text:
            return b"".join(self._learned(x.encode()) for x in _CUTS.split(self._folded(text)))
        return None

    def _piece_ids(self, pieces: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``pieces``, joined, and how many each has."""
        words = pc.utf8_rtrim(pieces, _SIGNS)
        closed = pc.and_(
            pc.is_in(pc.utf8_slice_codeunits(words, -1), _LATIN),
            pc.less(pc.binary_length(words), pc.binary_length(pieces)),
        )
        signs = pc.replace_substring_regex(pieces.filter(closed), _BEFORE_SIGNS, "")
        numbered = pa.concat_arrays([pc.if_else(closed, words, pieces), signs]).dictionary_encode()
        parts = numbered.dictionary.cast(pa.large_binary()).to_pylist()
        ids = list(map(self.known.get, parts))
        for at, known in enumerate(ids):
            if known is None:
                ids[at] = self._learned(parts[at])
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        index = numbered.indices.to_numpy()
        closed = closed.to_numpy(zero_copy_only=False)
        place = np.arange(len(pieces)) + np.cumsum(closed) - closed
        order = np.empty(len(index), np.int64)
        order[place] = index[: len(pieces)]
        order[place[closed] + 1] = index[len(pieces) :]
        flat, ends = _gathered(np.frombuffer(b"".join(ids), "<u4"), size, order)
        return flat, np.diff(ends[np.append(place, len(index))])

    def encode(self, texts: list[str]) -> list[bytes]:
        apart = [self._apart(x) for x in texts]
        cut = pa.array([self._cut(x) for x, ids in zip(texts, apart, strict=True) if ids is None], pa.large_string())
        lists = pc.split_pattern(cut, "\0")
        begins, numbered = lists.offsets.to_numpy(), lists.values.dictionary_encode()
        del cut, lists
        joined, ends = _gathered(*self._piece_ids(numbered.dictionary), numbered.indices.to_numpy())
        joined = joined.tobytes()
        at = (4 * ends[begins]).tolist()
        rest = (joined[a:b] for a, b in zip(at[:-1], at[1:], strict=True))
        return [next(rest) if ids is None else ids for ids in apart]


_ENCODERS: dict[tuple[str, int | None], Encoder] = {}


def encoder(path: str, remembered: int | None = None) -> Encoder:
    """The encoder of this worker process for the tokenizer file at ``path``."""
    if (path, remembered) not in _ENCODERS:
        _ENCODERS[path, remembered] = Encoder(path, remembered)
    return _ENCODERS[path, remembered]
