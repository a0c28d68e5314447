"""Text to token ids with the tokenizers library, word by word.

The library's own model encodes every pre-token; this module only avoids
encoding the same word again. Both pre-tokenizers handled here cut at white
space, so a text's ids are those of its space-separated chunks in turn, provided
that its white space and characters are plain (conditions below). Any other
text, and any other kind of tokenizer, goes through the library whole."""

from __future__ import annotations

import json
from array import array

import numpy as np
import regex
from tokenizers import Tokenizer

CACHE_WORDS = 600_000  # entries of each of the two caches of a worker process
# Letters whose class and lower case agree in all Unicode versions; U+0130 grows when lowered.
_ODD = regex.compile("[^\n\\x20-\\x7e¡-įı-ɏ]")
_ODD_SPACE = regex.compile("  | \n|\n |\n\n")
_MARKS = frozenset(".,;:!?%&$#*|)")
# The patterns of the two pre-tokenizers.
_BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies use for bytes: printable Latin-1
    characters stand for themselves, the rest follow from U+0100."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Words(dict):
    def __init__(self, encode):
        super().__init__()
        self._encode = encode

    def __missing__(self, chunk: str) -> bytes:
        ids = self._encode(chunk)
        if len(self) < CACHE_WORDS:
            self[chunk] = ids
        return ids


class Encoder:
    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # names of special tokens in a text are ordinary text
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self._letters = _byte_letters()
        kind = self._kind()
        self._model = self.tokenizer.model
        self._pattern = regex.compile(_WORD_PATTERN if kind == "word" else _BYTE_PATTERN)
        self._words, self._known = _Words(self._chunk), _Words(self._piece)
        self._code = "H" if self.dtype == np.uint16 else "I"
        self._fast = {"byte": self._bytes_text, "word": self._words_text}.get(kind)

    def _kind(self) -> str | None:
        spec = json.loads(self.tokenizer.to_str())
        pre, norm = spec["pre_tokenizer"] or {}, spec["normalizer"]
        if spec["post_processor"] and spec["post_processor"]["type"] != "ByteLevel":
            return None
        if norm is None and pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]:
            return "byte"
        steps = pre.get("pretokenizers", [])
        lowers = norm and [x["type"] for x in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        if lowers and [x["type"] for x in steps] == ["Split", "ByteLevel"] and not steps[1]["use_regex"] and not steps[1]["add_prefix_space"]:
            cut = steps[0]
            if cut["pattern"] == {"Regex": _WORD_PATTERN} and cut["behavior"] == "Removed" and cut["invert"]:
                return "word"
        return None

    def _piece(self, piece: str) -> bytes:
        """Ids of one pre-token, by the library's model."""
        letters = piece.encode().decode("latin-1").translate(self._letters)
        return array(self._code, [t.id for t in self._model.tokenize(letters)]).tobytes()

    def _chunk(self, key: str) -> bytes:
        """Keys of the byte kind: ``\x01`` starts the first chunk of a text, a
        line feed stands for itself, any other chunk follows one space. A word
        with at most one mark after it needs no pattern to be cut."""
        space = " " if self._fast == self._bytes_text else ""
        if key.isalpha():
            return self._known[space + key]
        if key[-1:] in _MARKS and key[:-1].isalpha():
            return self._known[space + key[:-1]] + self._known[key[-1]]
        text = key if not space or key[:1] == "\n" else key[1:] if key[:1] == "\x01" else space + key
        return b"".join(map(self._known.__getitem__, self._pattern.findall(text)))

    def _bytes_text(self, text: str) -> bytes | None:
        if _ODD_SPACE.search(text):
            return None
        parts = text.replace("\n", " \n").split(" ")
        parts[0] = "\x01" + parts[0]
        return b"".join(map(self._words.__getitem__, parts))

    def _words_text(self, text: str) -> bytes:
        return b"".join(map(self._words.__getitem__, text.lower().split()))

    def encode(self, text: str) -> bytes:
        """The ids of a whole text as little-endian values of ``dtype``."""
        if self._fast and not _ODD.search(text):
            ids = self._fast(text)
            if ids is not None:
                return ids
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def release() -> bool:
    """Let go of the encoders and what they have kept; False if there were none."""
    had = bool(_encoders)
    _encoders.clear()
    return had


def id_bytes(path: str) -> int:
    """Bytes of an id of a tokenizer file, without loading it in this process for good."""
    return 2 if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else 4


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file on this machine and its executors."""
    import public_tokenizers

    return public_tokenizers.path(name)
