"""Byte-pair encoding and decoding as streaming transducers, from a public tokenizer file.

Encoding. A merge can be pre-empted only by an earlier merge that takes symbols to its right, that one only by
a still earlier one, and so on; so what happens at a place depends on a bounded number of
symbols behind it. ``sufficient_lookahead`` computes this bound from the merge list. A pre-token is
read into a window of fixed size; tokens that end further from the window's edge than the bound are
stable, are emitted and leave the window. Memory is constant however long a pre-token is.

Decoding. Bytes of the tokens go through an incremental UTF-8 decoder, which holds back an unfinished
character; a file without a decoder joins the tokens' texts with spaces, as the tokenizers library does.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from collections.abc import Iterable, Iterator
from itertools import chain, islice
from unicodedata import is_normalized

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleetgauge.llm.batches import map_batches, text_slices, texts_of

#: Chunks of text a task remembers the ids of, and the characters of the longest one it remembers.
REMEMBERED = 600_000
LONGEST_REMEMBERED = 256

#: Characters of text, or ids of a run without white space, that are encoded and decoded at once.
BLOCK = 1 << 16

#: Last character that all Unicode versions class alike, with all before it.
LATIN = chr(0x24F)

#: White space as the tokenizers library's patterns understand ``\s``. A fixed value.
_SPACE = "".join(
    map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
#: The pattern of a byte-level pre-tokenizer with ``use_regex``. A fixed value.
_BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(byte if byte in shown else next(hidden)) for byte in range(256)]


def sufficient_lookahead(merges: Iterable[tuple[str, str]], suffix: str = "") -> int:
    """Symbols behind a place that can decide whether a token ends there.

    A merge (u, v) needs v whole, which is ``len(v)`` symbols; an earlier merge (p, w) whose p ends v may
    take v's end away, which depends on w, and so on. Only earlier merges can pre-empt, so the
    longest chain is found in one pass over the list.
    """

    def symbols(token: str) -> int:
        return len(token.removesuffix(suffix)) if suffix else len(token)

    reach: dict[str, int] = {}
    longest = 1
    for left, right in merges:
        plain = right.removesuffix(suffix) if suffix else right
        behind = max((reach.get(right[at:], 0) for at in range(len(plain))), default=0)
        here = symbols(right) + behind
        if here > reach.get(left, 0):
            reach[left] = here
        longest = max(longest, here)
    return longest


class BpeTransducer:
    """Encoder and decoder of a tokenizer file of the tokenizers library that holds a BPE model."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("continuing_subword_prefix"):
            raise ValueError(f"not a byte-level BPE tokenizer: {path}")
        self.suffix = model.get("end_of_word_suffix") or ""
        self.vocabulary = model["vocab"]
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(merges)}
        self.lookahead = sufficient_lookahead(merges, self.suffix)
        self.window = 2 * (self.lookahead + max((len(a) + len(b) for a, b in merges), default=1))
        self.marks = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.mark = regex.compile("|".join(regex.escape(m) for m in sorted(self.marks, key=len, reverse=True)) or r"(?!)")
        library = Tokenizer.from_file(path)
        self.normalizer, self.library_splitter = library.normalizer, library.pre_tokenizer
        self._read_splitter(spec["pre_tokenizer"])
        self.bytes_as = byte_characters()
        self.tokens = {i: token for token, i in (self.vocabulary | self.marks).items()}
        self.byte_decoder = (spec.get("decoder") or {}).get("type") == "ByteLevel"
        self.token_bytes = self._token_bytes() if self.byte_decoder else {}
        self.remembered = remembered
        self.known = _Remembered(self._find)
        self.mark_in_any_case = regex.compile(self.mark.pattern, regex.IGNORECASE)
        # Runs of letters are one pre-token, and lower-casing A to Z first changes nothing.
        self.plain_words = (
            self.drops_space and "Lowercase()" in repr(self.normalizer) and r"[\p{L}]+" in self.splitter.pattern
        )

    def _read_splitter(self, splitter: dict) -> None:
        steps = splitter["pretokenizers"] if splitter["type"] == "Sequence" else [splitter]
        split = next((s for s in steps if s["type"] == "Split"), None)
        pattern = split["pattern"]["Regex"] if split else _BYTE_LEVEL
        self.drops_space = split is not None
        exact = pattern.replace(r"[^\s", f"[^{_SPACE}").replace(r"\S", f"[^{_SPACE}]").replace(r"\s", f"[{_SPACE}]")
        self.splitter = regex.compile(exact)

    def normalize(self, text: str) -> str:
        """The text as the file's normalizer has it, by the library's own Unicode tables."""
        return self.normalizer.normalize_str(text) if self.normalizer else text

    def pre_tokens(self, text: str) -> list[str]:
        """Byte characters of each pre-token of a normalized text."""
        if text > "" and max(text) > LATIN:
            # Unicode versions differ in what they call a letter: leave it to the library's tables.
            return [piece for piece, _ in self.library_splitter.pre_tokenize_str(text)]
        return [
            "".join(map(self.bytes_as.__getitem__, piece.encode())) for piece in self.splitter.findall(text)
        ]

    def symbols(self, pre_token: str) -> Iterator[str]:
        """Symbols of a pre-token: its byte characters, the last with the end-of-word suffix."""
        last = len(pre_token) - 1
        return (char + self.suffix if at == last else char for at, char in enumerate(pre_token))

    def merge(self, parts: list[str]) -> list[str]:
        """Apply the merge list to a sequence of symbols, the earliest merge first, leftmost first."""
        ranks = self.ranks
        none = len(ranks)
        found = [ranks.get(pair, none) for pair in zip(parts, parts[1:])]  # noqa: B905
        while found and (best := min(found)) < none:
            at = found.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del found[at]
            if at:
                found[at - 1] = ranks.get((parts[at - 1], parts[at]), none)
            if at < len(found):
                found[at] = ranks.get((parts[at], parts[at + 1]), none)
        return parts

    def transduce(self, symbols: Iterable[str]) -> Iterator[str]:
        """Tokens of a symbol stream of any length, each emitted once it is stable."""
        held: list[str] = []
        symbols = iter(symbols)
        while len(held) < (fill := self.window + self.lookahead) and (more := list(islice(symbols, fill - len(held)))):
            held += more
            if len(held) == fill:
                read = 0
                for token in self.merge(held.copy()):
                    if read + len(token) > self.window:
                        break
                    read += len(token)
                    yield token
                del held[:read]
        yield from self.merge(held)

    def chunk_ids(self, chunk: str) -> Iterator[int]:
        """Ids of a text without splitting it at white space first, each once it is stable."""
        at = 0
        for match in chain(self.mark.finditer(chunk), [None]):
            plain = self.normalize(chunk[at : match.start() if match else len(chunk)])
            for pre_token in self.pre_tokens(plain):
                for token in self.transduce(self.symbols(pre_token)):
                    yield self.vocabulary[token]
            if match:
                yield self.marks[match[0]]
                at = match.end()

    def encode_chunk(self, chunk: str) -> tuple[int, ...]:
        return tuple(self.chunk_ids(chunk))

    def chunks(self, text: str) -> list[str]:
        # Where white space is dropped, any of it parts pre-tokens whatever stands around.
        return text.replace("\n", " ").split(" ") if self.drops_space else [text]

    def _find(self, chunk: str) -> tuple[tuple[int, ...], str]:
        """Ids of a chunk, as numbers and as decimal text; common shapes go by way of shorter chunks."""
        known = self.known
        if self.plain_words and chunk and max(chunk) <= LATIN and not self.mark_in_any_case.search(chunk):
            if len(chunk) > 1 and chunk[-1] in ".," and chunk[-2].lower().isalpha():
                word, stop = known[chunk[:-1]], known[chunk[-1]]
                return word[0] + stop[0], f"{word[1]} {stop[1]}"
            if chunk.isascii() and (lower := chunk.lower()) != chunk:
                return known[lower]
            if chunk.isalpha() and chunk.islower() and is_normalized("NFC", chunk):
                symbols = self.symbols("".join(map(self.bytes_as.__getitem__, chunk.encode())))
                ids = tuple(map(self.vocabulary.__getitem__, self.transduce(symbols)))
                return ids, " ".join(map(str, ids))
        ids = self.encode_chunk(chunk)
        return ids, " ".join(map(str, ids))

    def _found(self, text: str) -> list[tuple[tuple[int, ...], str]]:
        if not self.drops_space:
            return [self._find(text)]
        if len(self.known) > self.remembered:
            self.known.clear()
        return list(map(self.known.__getitem__, self.chunks(text)))

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text, without the ids that some tokenizers add around it."""
        return list(chain.from_iterable([ids for ids, _ in self._found(text)]))

    def encode_with_text(self, text: str) -> tuple[list[int], str]:
        """Ids of a whole text, and the same in decimal, joined by one space."""
        found = self._found(text)
        return list(chain.from_iterable([ids for ids, _ in found])), " ".join([shown for _, shown in found if shown])

    def _blocks(self, text: str) -> Iterator[str]:
        """The text in blocks, cut at white space that is dropped; a longer one is a run without any."""
        at = 0
        while self.drops_space and len(text) - at > BLOCK:
            end = max(text.rfind(space, at, at + BLOCK) for space in " \n")
            if end < 0:
                end = min((found for space in " \n" if (found := text.find(space, at)) >= 0), default=len(text))
            yield text[at:end]
            at = end + 1
        if at <= len(text):
            yield text[at:]

    def encode_pieces(self, text: str) -> Iterator[tuple[list[int], str]]:
        """Ids of a whole text and the same in decimal, in pieces of bounded size, none of them empty."""
        for block in self._blocks(text):
            if len(block) <= BLOCK:
                piece = self.encode_with_text(block)
                if piece[0]:
                    yield piece
                continue
            ids = self.chunk_ids(block)
            while piece := list(islice(ids, BLOCK)):
                yield piece, " ".join(map(str, piece))

    def encode_stream(self, blocks: Iterable[str]) -> Iterator[int]:
        """Ids of a text that arrives in blocks; only an unfinished run without white space is held."""
        if not self.drops_space:
            raise ValueError("this tokenizer keeps white space: encode whole texts")
        rest = ""
        for block in blocks:
            *done, rest = (rest + block).replace("\n", " ").split(" ")
            for chunk in done:
                yield from self.encode_chunk(chunk)
        yield from self.encode_chunk(rest)

    def _token_bytes(self) -> dict[int, bytes]:
        value = {char: byte for byte, char in enumerate(self.bytes_as)}
        marks = set(self.marks.values())
        return {
            i: token.encode() if i in marks else bytes(value[char] for char in token)
            for i, token in self.tokens.items()
        }

    def decode_pieces(self, pieces: Iterable[list[int]]) -> Iterator[str]:
        """Text of each piece of a stream of ids; ids outside the vocabulary are passed over.

        A file without a byte-level decoder means by decoding the tokens' texts joined by spaces.
        """
        if self.byte_decoder:
            decoder = codecs.getincrementaldecoder("utf-8")("replace")
            for ids in pieces:
                yield decoder.decode(b"".join([self.token_bytes.get(i, b"") for i in ids]))
            yield decoder.decode(b"", True)
        else:
            space = ""
            for ids in pieces:
                try:
                    tokens = list(map(self.tokens.__getitem__, ids))
                except KeyError:
                    tokens = [self.tokens[i] for i in ids if i in self.tokens]
                if tokens:
                    yield space + " ".join(tokens)
                    space = " "

    def decode_stream(self, ids: Iterable[int]) -> Iterator[str]:
        """Text of a stream of ids, id by id."""
        return self.decode_pieces([i] for i in ids)

    def decode(self, ids: list[int]) -> str:
        return "".join(self.decode_pieces([ids]))

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of ids, and SHA-256 of the decimal ids and of the decoded text, both fed piece by piece."""
        count, encoded, decoded = 0, hashlib.sha256(), hashlib.sha256()

        def pieces() -> Iterator[list[int]]:
            nonlocal count
            for ids, shown in self.encode_pieces(text):
                encoded.update(f" {shown}".encode() if count else shown.encode())
                count += len(ids)
                yield ids

        for part in self.decode_pieces(pieces()):
            decoded.update(part.encode())
        return count, encoded.hexdigest(), decoded.hexdigest()


class _Remembered(dict):
    """What is known of chunks, but long ones; a chunk that is met first is looked into by ``find``."""

    def __init__(self, find):
        self.find = find

    def __missing__(self, chunk: str):
        found = self.find(chunk)
        if len(chunk) <= LONGEST_REMEMBERED:
            self[chunk] = found
        return found


_transducers: dict[str, BpeTransducer] = {}


def transducer(path: str) -> BpeTransducer:
    """The transducer of this Python worker, which keeps what it remembers from task to task."""
    if path not in _transducers:
        _transducers[path] = BpeTransducer(path)
    return _transducers[path]


_ROUND_TRIP = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_ENCODED = "doc_id long, ids array<int>"
_DECODED = "doc_id long, text string"


def encode_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id and ids of each row of ``docs`` (doc_id, text); a NULL or empty text has no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = transducer(tokenizer_path).encode
        for batch in text_slices(batches):
            ids = [encode(text) for text in texts_of(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, _ENCODED)


def decode_documents(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id and text of each row of ``encoded`` (doc_id, ids); NULL ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = transducer(tokenizer_path).decode
        for batch in batches:
            texts = [decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts)], ["doc_id", "text"])

    return map_batches(encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids"), run, _DECODED)


def round_trip(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Encode and decode every whole text: doc_id, n_tokens, ids_sha256, decoded_sha256.

    ``ids_sha256`` is of the decimal ids joined by one space, ``decoded_sha256`` of the decoded text in
    UTF-8. A NULL text counts as empty: no ids, and both digests of the empty string. Rows are
    independent: NULL or repeated doc_ids stay as they are, other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = transducer(tokenizer_path)
        for batch in text_slices(batches):
            found = [bpe.digests(text) for text in texts_of(batch)]
            counts, encoded, decoded = zip(*found, strict=True) if found else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, "int64"), pa.array(encoded), pa.array(decoded)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, _ROUND_TRIP)
