"""Whole-text encoding by the tokenizers library, chunk by chunk.

The library's cost per character is high and words repeat, so a task encodes each distinct chunk of
text once and remembers its ids. Chunks are cut only where the tokenizer's own pre-tokenizer
always cuts, whatever stands around, so the ids of a text are those of its chunks in order.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from unicodedata import is_normalized

import numpy as np

from fleetgauge.llm.batches import Remembered
from fleetgauge.llm.bpe_stream import LATIN, byte_characters

#: Chunks a task remembers at most; then it starts afresh.
REMEMBERED = 600_000

_CODES = {"<u2": "H", "<u4": "I"}
_ODD_SPACE = re.compile(r"[^\S \n]")
_SPACED_CHUNK = re.compile(r" ?[^ \n]+|[ \n]+(?![^ \n])|\n")


class LibraryEncoder:
    """Encode texts as ``Tokenizer.from_file(path)`` does with ``add_special_tokens=False``.

    ``encode`` returns the ids of each text as little-endian unsigned integers of ``dtype``.
    """

    def __init__(self, path: str, dtype: str = "<u4", remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.dtype = dtype
        added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.marked = re.compile("|".join(map(re.escape, added)) or r"(?!)", re.IGNORECASE)
        self.bytes_as = byte_characters()
        normalizer, splitter = repr(self.tokenizer.normalizer), repr(self.tokenizer.pre_tokenizer)
        self.keeps_spaces = (
            splitter.startswith("ByteLevel(") and "use_regex=True" in splitter and normalizer == "None"
        )
        self.drops_spaces = (
            r'Regex("\s+"), content=" "), Lowercase()' in normalizer
            and r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+" in splitter
            and "behavior=Removed, invert=True" in splitter
            and not any(re.search(r"\s", mark) for mark in added)
        )
        self.ids = Remembered(self._ids_of, remembered)

    def _chunks(self, text: str) -> list[str]:
        if self.drops_spaces:
            # White space parts words and is dropped, so any of it may be cut out.
            return text.replace("\n", " ").split(" ")
        # One space goes with the word that follows it, other white space stands alone. Marked
        # tokens and other white space change what stands beside them: such texts go whole.
        if self.keeps_spaces and not self.marked.search(text) and not _ODD_SPACE.search(text):
            return _SPACED_CHUNK.findall(text)
        return [text]

    def _ids_of(self, chunk: str) -> bytes:
        if not chunk:
            return b""
        if (self.drops_spaces or self.keeps_spaces) and max(chunk) <= LATIN and not self.marked.search(chunk):
            if len(chunk) > 1 and chunk[-1] in ".," and chunk[-2].lower().isalpha():
                return self.ids[chunk[:-1]] + self.ids[chunk[-1]]
            if self.drops_spaces and chunk.isascii() and not chunk.islower():
                lower = chunk.lower()
                if lower != chunk:
                    return self.ids[lower]
            word = chunk.removeprefix(" ") if self.keeps_spaces else chunk
            if word.isalpha() and (self.keeps_spaces or word.islower() and is_normalized("NFC", word)):
                # A run of letters is one pre-token, so the model can be asked at once.
                pre_token = "".join(map(self.bytes_as.__getitem__, chunk.encode()))
                return self._packed([token.id for token in self.model.tokenize(pre_token)])
        return self._packed(self.tokenizer.encode(chunk, add_special_tokens=False).ids)

    def _packed(self, ids: list[int]) -> bytes:
        # For a few ids an array of the standard library is made much faster; it has the machine's byte order.
        if sys.byteorder == "little" and self.dtype in _CODES:
            return array(_CODES[self.dtype], ids).tobytes()
        return np.array(ids, self.dtype).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        ids_of = self.ids.__getitem__
        if self.drops_spaces or self.keeps_spaces:
            return [b"".join(map(ids_of, self._chunks(text))) for text in texts]
        return [self._ids_of(text) for text in texts]


_encoders: dict[tuple[str, str], LibraryEncoder] = {}


def encoder(path: str, dtype: str = "<u4") -> LibraryEncoder:
    """The encoder of this Python worker, which keeps what it remembers from task to task."""
    if (path, dtype) not in _encoders:
        _encoders[path, dtype] = LibraryEncoder(path, dtype)
    return _encoders[path, dtype]
