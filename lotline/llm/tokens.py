"""Encoding of a corpus with a public byte-level BPE tokenizer, and decoding of its ids.

The merges are compiled into a finite-state transducer over bytes that is determinised as texts need it. For every
prefix of a piece of text, the encoding of the prefix ends in one certain token; a state holds, for each place where a
coming token may start, the tokens of the prefix up to there that aren't sent yet. A token is sent once the encodings
up to all those places agree on it, so the lookahead is bounded by the longest token.
"""

from __future__ import annotations

import base64
import os
import re
from array import array
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from lotline.session import ship

#: Fixed value: the published pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same for texts of ASCII characters only, where the classes are small and the standard matcher is faster.
ASCII_PATTERN = PATTERN.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9").replace(" ?A-Za-z+", " ?[A-Za-z]+").replace(" ?0-9+", " ?[0-9]+").replace(r"[^\s", r"[^ \t\n\r\x0b\x0c").replace(r"\s", r"[ \t\n\r\x0b\x0c]").replace(r"\S", r"[^ \t\n\r\x0b\x0c]")
#: Where the vocabulary files lie, unless a path is given.
TOKENIZER_DIR = os.environ.get("LOTLINE_TOKENIZERS", "/opt/tokenizers")
BYTE_BPE_50K = "byte_bpe_50k.tiktoken"
#: Entries after which a lazily filled table is emptied; they bound memory, never the result.
MAX_ARCS, MAX_PIECES = 1_000_000, 300_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class BpeTransducer:
    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.prefixes = {b[:k] for b in ranks for k in range(1, len(b) + 1)}
        self.longest = max(map(len, ranks))
        self._pairs: dict[tuple[int | None, int], bool] = {}
        self._reset()

    def _reset(self) -> None:
        start = (None, ((b"", ()),))
        self._ids = {start: 0}
        self._states = [start]
        self._arcs: dict[int, tuple[int, tuple[int, ...]]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """The definition: join the pair of least rank, again and again. Only used on one or two tokens at a time."""
        parts, get = [piece[i : i + 1] for i in range(len(piece))], self.ranks.get
        none = 1 << 60
        while len(parts) > 1:
            rank = [get(a + b, none) for a, b in pairwise(parts)]
            best = min(rank)
            if best == none:
                break
            at = rank.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _follows(self, before: int | None, token: int) -> bool:
        """Whether the merges leave ``token`` whole, apart from ``before``."""
        key = (before, token)
        if (known := self._pairs.get(key)) is None:
            whole = [token] if before is None else [before, token]
            if len(self._pairs) > MAX_ARCS:
                self._pairs.clear()
            known = self._pairs[key] = self.merge(b"".join(self.bytes_of[t] for t in whole)) == whole
        return known

    def _arc(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """Determinise one step: the next state and the tokens that are settled by it."""
        last, places = self._states[state]
        b = bytes((byte,))
        path, live, ranks, prefixes = None, [], self.ranks, self.prefixes
        for text, unsent in places:  # the earliest place gives the longest token
            text += b
            if path is None:
                token = ranks.get(text)
                if token is not None and self._follows(unsent[-1] if unsent else last, token):
                    path = (*unsent, token)
            if text in prefixes:
                live.append((text, unsent))
        if path is None:
            raise ValueError("the vocabulary lacks a byte")
        live.append((b"", path))
        first, n = live[0][1], 0
        least = min(len(u) for _, u in live)
        while n < least and all(u[n] == first[n] for _, u in live):
            n += 1
        sent = first[:n]
        nxt = (sent[-1] if sent else last, tuple((t, u[n:]) for t, u in live))
        at = self._ids.get(nxt)
        if at is None:
            at = self._ids[nxt] = len(self._states)
            self._states.append(nxt)
        arc = self._arcs[state << 8 | byte] = (at, sent)
        return arc

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        whole = self.ranks.get(piece)
        if whole is not None and self._follows(None, whole):
            return (whole,)
        if len(self._arcs) > MAX_ARCS:
            self._reset()
        arcs, state, out = self._arcs, 0, []
        for byte in piece:
            arc = arcs.get(state << 8 | byte)
            if arc is None:
                if len(arcs) > MAX_ARCS:  # within a long piece only the present state is kept
                    here = self._states[state]
                    self._reset()
                    arcs, state = self._arcs, len(self._states)
                    self._states.append(here)
                    self._ids[here] = state
                arc = self._arc(state, byte)
            state, sent = arc
            if sent:
                out.extend(sent)
        out.extend(self._states[state][1][-1][1])  # at the end the last place holds the whole piece
        return tuple(out)


class Pieces(dict):
    """The encodings of pieces; one that is missing goes through the transducer."""

    def __init__(self, fst: BpeTransducer) -> None:
        super().__init__()
        self.fst = fst

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.fst.encode_piece(piece.encode("utf-8"))
        if len(piece) <= 64:
            if len(self) >= MAX_PIECES:
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """Whole texts: the pattern cuts pieces, the transducer encodes each; pieces seen before are looked up."""

    def __init__(self, path: str) -> None:
        self.fst = BpeTransducer(load_ranks(path))
        self.cut = regex.compile(PATTERN).findall
        self.cut_ascii = re.compile(ASCII_PATTERN).findall
        self.seen = Pieces(self.fst)

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        return list(chain.from_iterable(map(self.seen.__getitem__, self.cut_ascii(text) if text.isascii() else self.cut(text))))


class Utf8Stream:
    """An incremental UTF-8 state machine: bytes in, characters out as soon as they are whole.

    The state is the number of bytes still due, the bits so far and the bounds of the next byte. What cannot become a
    character gives U+FFFD once for each maximal part.
    """

    def __init__(self) -> None:
        self.due, self.bits, self.low, self.high = 0, 0, 0x80, 0xBF

    def feed(self, data: bytes) -> str:
        out = []
        for b in data:
            if self.due:
                if self.low <= b <= self.high:
                    self.bits = self.bits << 6 | b & 0x3F
                    self.due -= 1
                    self.low, self.high = 0x80, 0xBF
                    if not self.due:
                        out.append(chr(self.bits))
                    continue
                out.append("�")
                self.due, self.low, self.high = 0, 0x80, 0xBF
            if b < 0x80:
                out.append(chr(b))
            elif 0xC2 <= b <= 0xDF:
                self.due, self.bits = 1, b & 0x1F
            elif 0xE0 <= b <= 0xEF:
                self.due, self.bits = 2, b & 0x0F
                self.low, self.high = (0xA0 if b == 0xE0 else 0x80), (0x9F if b == 0xED else 0xBF)
            elif 0xF0 <= b <= 0xF4:
                self.due, self.bits = 3, b & 0x07
                self.low, self.high = (0x90 if b == 0xF0 else 0x80), (0x8F if b == 0xF4 else 0xBF)
            else:
                out.append("�")
        return "".join(out)

    def end(self) -> str:
        rest = "�" if self.due else ""
        self.__init__()
        return rest


class StreamDecoder:
    """Ids in, text out, token by token."""

    def __init__(self, bytes_of: dict[int, bytes]) -> None:
        self.bytes_of, self.utf8 = bytes_of, Utf8Stream()

    def push(self, token: int) -> str:
        return self.utf8.feed(self.bytes_of[token])

    def end(self) -> str:
        return self.utf8.end()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each vocabulary and Python worker, kept between batches and tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def vocabulary(name: str = BYTE_BPE_50K, folder: str | None = None) -> str:
    return os.path.join(folder or TOKENIZER_DIR, name)


def encode_documents(df: DataFrame, key: str, text: str, path: str) -> DataFrame:
    """(key, ids array<int>) of every row, whole texts. NULL and empty texts give an empty list; repeated rows repeat.

    Special tokens' strings are ordinary text. Extra columns are left out. No shuffle: one narrow pass.
    """
    import pyspark.sql.functions as F

    ship(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            for k in range(0, b.num_rows, 1024):
                part = b.slice(k, 1024)
                flat, ends = array("i"), [0]
                for t in part.column(1).to_pylist():
                    flat.extend(enc.encode(t))
                    ends.append(len(flat))
                ids = pa.ListArray.from_arrays(pa.array(np.array(ends, np.int32)), pa.array(np.frombuffer(flat, np.int32) if flat else np.empty(0, np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], names=[key, "ids"])

    return df.select(F.col(f"`{key}`"), F.col(f"`{text}`").cast("string")).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def count_tokens(df: DataFrame, text: str, path: str) -> DataFrame:
    """``df`` without ``text``, plus n_tokens int (a column of that name is replaced); NULL and empty texts count 0."""
    from pyspark.sql.types import IntegerType, StructField, StructType

    ship(df.sparkSession)
    keep = [c for c in df.columns if c not in (text, "n_tokens")]
    schema = StructType([*(df.schema[c] for c in keep), StructField("n_tokens", IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            n = [len(enc.encode(t)) for t in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(n, pa.int32())], names=[*keep, "n_tokens"])

    return df.select(*[f"`{c}`" for c in keep], f"`{text}`").mapInArrow(run, schema)


def decode_ids(df: DataFrame, key: str, ids: str, path: str) -> DataFrame:
    """(key, text) from lists of ids, through the incremental decoder; NULL lists give NULL."""
    ship(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = encoder(path).fst.bytes_of
        for b in batches:
            texts = []
            for row in b.column(1).to_pylist():
                if row is None:
                    texts.append(None)
                    continue
                d = StreamDecoder(bytes_of)
                texts.append("".join(map(d.push, row)) + d.end())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    return df.select(key, ids).mapInArrow(run, f"`{key}` {kind}, text string")
