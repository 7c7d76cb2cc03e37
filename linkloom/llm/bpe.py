"""Byte-level BPE through sentencepiece.

A rank file (base64 token, rank) becomes a sentencepiece BPE model without any
training: the protobuf message is written here field by field.  Each byte of a
token is mapped to one code point, a piece's score is its negative rank, and the
normaliser is the identity, so that the highest-scoring merge is the lowest rank.

Edge cases: a null text is read as empty and gives no ids; empty texts give no
ids; texts of any length are encoded whole; repeated rows are encoded each by
itself; extra columns are ignored, even with the names of the result.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import batches_of, values

#: First code point of the 256 that stand for bytes.
BYTE_AT = 0x100
#: A code point of no piece: no merge crosses it, and it comes back as the unknown piece.
BETWEEN = "\n"
#: Characters encoded by one call, unless a single pre-token has more.
CALL_CHARS = 1 << 16
#: The pattern whose matches may be cut before spaces (fixed value), and where that is not so.
CUTTABLE = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LOOSE = re.compile(r" (?:[\s\x1c-\x1f]|\Z)").search
#: Encoded pre-tokens kept by a worker, in entries and in characters of the longest one kept.
CACHE_ENTRIES, CACHE_CHARS = 300_000, 64

SCHEMA = "doc_id long, n_tokens long, ids binary, decoded binary"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


SHIFT = {b: BYTE_AT + b for b in range(256)}


def byte_string(data: bytes) -> str:
    return data.decode("latin-1").translate(SHIFT)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, payload: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(payload)) + payload


def _flag(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def model_proto(ranks: dict[bytes, int]) -> bytes:
    """The serialised ModelProto: an unknown piece with id 0, then the tokens by rank, each with id rank order + 1."""
    unknown = _field(1, "<unk>".encode()) + struct.pack("<Bf", 2 << 3 | 5, 0.0) + _flag(3, 2)
    out = bytearray(_field(1, unknown))
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        out += _field(1, _field(1, byte_string(token).encode()) + struct.pack("<Bf", 2 << 3 | 5, -float(rank)))
    trainer = _flag(3, 2) + _flag(4, len(ranks) + 1)  # model_type BPE, vocab_size
    normalizer = _field(1, b"identity") + _flag(3, 0) + _flag(4, 0) + _flag(5, 0)  # no dummy prefix, white space as it is
    return bytes(out + _field(2, trainer) + _field(3, normalizer))


class Codec:
    """encode() gives ids as little-endian 32-bit integers; decode() is its inverse."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        import sentencepiece

        self.ranks = ranks
        self.pretokens = regex.compile(pattern).findall
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_proto(ranks))
        by_rank = sorted(ranks.items(), key=lambda x: x[1])
        self.rank_of_piece = np.array([0, *(r for _, r in by_rank)], "<u4")
        self.token = {r: t for t, r in by_rank}
        self.cache: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.cuttable = pattern == CUTTABLE

    def _fill(self, missing: list[str]) -> dict[str, bytes]:
        """Ids of pre-tokens: a whole token at once, else merges by sentencepiece."""
        out, split = {}, []
        for s in missing:
            data = s.encode()
            if (rank := self.ranks.get(data)) is not None:
                out[s] = struct.pack("<I", rank)
            else:
                split.append((s, data))
        start = 0
        while start < len(split):
            end, size = start, 0
            while end < len(split) and (end == start or size + len(split[end][1]) <= CALL_CHARS):
                size += len(split[end][1])
                end += 1
            joined = BETWEEN.join([byte_string(d) for _, d in split[start:end]])
            pieces = np.array(self.model.encode(joined, num_threads=1), np.int64)
            cuts = np.flatnonzero(pieces == 0)
            ids = self.rank_of_piece[pieces].tobytes()
            for (s, _), i, j in zip(split[start:end], [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(pieces)]):
                out[s] = ids[4 * i : 4 * j]
            start = end
        return out

    def _ids(self, tokens: list[str]) -> bytes:
        cache = self.cache
        if missing := {t for t in tokens if t not in cache}:
            fresh = self._fill(list(missing))
            out = b"".join([fresh[t] if t in fresh else cache[t] for t in tokens])
            if len(cache) > CACHE_ENTRIES:
                cache.clear()
            cache.update((t, ids) for t, ids in fresh.items() if len(t) <= CACHE_CHARS)
            return out
        return b"".join([cache[t] for t in tokens])

    def encode(self, text: str) -> bytes:
        """The ids of all matches of the pattern.

        A space before a character that isn't white space always starts a match, as
        no class of the pattern holds white space and others together; so unless a space
        stands before white space or the end, the text may be cut before each space.
        """
        if not self.cuttable or LOOSE(text):
            return self._ids(self.pretokens(text))
        words = self.words
        first, *rest = text.split(" ")
        if missing := {w for w in rest if w not in words}:
            missing = list(missing)
            tokens = [self.pretokens(" " + w) for w in missing]
            self._ids([t for ts in tokens for t in ts])  # all at once, for the cache
            fresh = {w: self._ids(ts) for w, ts in zip(missing, tokens)}
            out = b"".join([fresh[w] if w in fresh else words[w] for w in rest])
            if len(words) > CACHE_ENTRIES:
                words.clear()
            words.update((w, ids) for w, ids in fresh.items() if len(w) <= CACHE_CHARS)
        else:
            out = b"".join([words[w] for w in rest])
        return self._ids(self.pretokens(first)) + out

    def decode(self, ids: bytes) -> bytes:
        token = self.token
        return b"".join([token[i] for i in np.frombuffer(ids, "<u4").tolist()])


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec for each vocabulary and process."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(read_ranks(path), pattern)
    return _CODECS[path, pattern]


def _mapped(df: DataFrame, path: str, pattern: str, row: Callable[[int, str, bytes, Codec], tuple], schema: str, arrow: pa.Schema) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)

        def rows() -> Iterator[tuple]:
            for b in batches:
                for doc_id, text in zip(values(b.column(0)), values(b.column(1))):
                    text = text or ""
                    yield row(doc_id, text, own.encode(text), own)

        yield from batches_of(rows(), arrow)

    return df.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def encode(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit), decoded (bytes from the ids) for every row of doc_id, text."""
    arrow = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])
    return _mapped(df, path, pattern, lambda d, _, ids, c: (d, len(ids) // 4, ids, c.decode(ids)), SCHEMA, arrow)


def digests(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """encode() with ids and decoded bytes as SHA-256 digests."""
    out = encode(df, path, pattern)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
