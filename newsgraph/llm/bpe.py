"""Byte-level BPE encoding and decoding with a sentencepiece BPE model written straight from a rank file.

A rank file lists byte strings with ranks; byte-pair encoding joins the neighbours whose union has the lowest rank. A
sentencepiece BPE model joins the neighbours whose union has the highest score. So every byte string becomes a piece of
one character per byte, scored by its negative rank, under an identity normaliser, and both join in the same order, the
leftmost first where scores tie. Pre-tokens are split off before, so the model never sees more than one.
"""

from __future__ import annotations

import base64
import struct
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsgraph.llm import pretokens
from newsgraph.llm.batches import map_texts

# Bytes 0-255 stand as the characters from here on: all single code points, none white space.
FIRST_CHAR = 0x100
# A worker keeps the ids of so many pre-tokens besides those of the vocabulary, then starts afresh.
CACHE_ROWS = 500_000
# A longer pre-token is encoded anew each time, so that the cache stays small in bytes as well.
CACHED_CHARS = 64


def read_ranks(path: str) -> dict[bytes, int]:
    """Byte string to rank, from a file of base64 and rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def as_chars(data: bytes) -> str:
    """One character per byte."""
    return data.decode("latin-1").translate(_UP)


def as_bytes(chars: str) -> bytes:
    """The inverse of `as_chars`."""
    return bytes(ord(c) - FIRST_CHAR for c in chars)


_UP = {b: FIRST_CHAR + b for b in range(256)}


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """Serialised sentencepiece BPE model: piece number = rank, score = negative rank.

    The unknown piece, which the format demands, takes the number after the last rank; with all 256 bytes in the
    vocabulary it never occurs. A gap in the ranks is filled with an unused piece.
    """
    from sentencepiece import sentencepiece_model_pb2 as pb

    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"the vocabulary lacks {len(missing)} single bytes, so not every text can be encoded")
    if len(set(ranks.values())) != len(ranks):
        raise ValueError("two byte strings share a rank")
    model = pb.ModelProto()
    by_rank = {rank: data for data, rank in ranks.items()}
    size = max(by_rank) + 1
    for rank in range(size):
        piece = model.pieces.add()
        if rank in by_rank:
            piece.piece, piece.score, piece.type = as_chars(by_rank[rank]), -float(rank), pb.ModelProto.SentencePiece.NORMAL
        else:
            piece.piece, piece.score, piece.type = f"<gap{rank}>", -float(rank), pb.ModelProto.SentencePiece.UNUSED
    unknown = model.pieces.add()
    unknown.piece, unknown.score, unknown.type = "<unk>", 0.0, pb.ModelProto.SentencePiece.UNKNOWN
    model.trainer_spec.model_type = pb.TrainerSpec.BPE
    model.trainer_spec.vocab_size = size + 1
    model.trainer_spec.unk_id, model.trainer_spec.bos_id, model.trainer_spec.eos_id, model.trainer_spec.pad_id = size, -1, -1, -1
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = False
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = False
    return model.SerializeToString()


def split_spec(pattern: str) -> tuple[str, str, str, str]:
    """The pattern with the characters that tiktoken classes differently from the regex module here."""

    def pieces_by_line(strings: list[str]) -> list[int]:
        ranks = {bytes([b]): b for b in range(256)}
        for s in strings:
            ranks.setdefault(s.encode(), len(ranks))
        probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        counts, end = [0], ord("\n")
        for number in probe.encode_ordinary("\n".join(strings)):
            if number == end:
                counts.append(0)
            else:
                counts[-1] += 1
        return counts

    return (pattern, *pretokens.disputed(pieces_by_line))


class _Encoder(dict):
    """Per-worker state: pre-token to id bytes, for the vocabulary and, as a bounded cache, for what else was met."""

    def __init__(self, model: bytes, spec: tuple[str, str, str, str]):
        import sentencepiece

        super().__init__()
        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.spec, self.encode_one = spec, processor.encode_as_ids
        # a pre-token that is in the vocabulary is its own token, whatever joins would give
        for number in range(processor.get_piece_size() - 1):
            if not processor.is_unused(number):
                try:
                    self[as_bytes(processor.id_to_piece(number)).decode()] = number.to_bytes(4, "little")
                except UnicodeDecodeError:
                    continue
        self.known = dict(self)

    def __missing__(self, pretoken: str) -> bytes:
        numbers = self.encode_one(as_chars(pretoken.encode()))
        packed = struct.pack(f"<{len(numbers)}I", *numbers)
        if len(pretoken) <= CACHED_CHARS:
            self[pretoken] = packed
        return packed

    def ids(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if len(self) > len(self.known) + CACHE_ROWS:
            self.clear()
            self.update(self.known)
        return b"".join([b"".join(map(self.__getitem__, part)) for part in pretokens.pretoken_lists(text, self.spec)])


class _Decoder:
    """Per-worker state: the bytes of every piece number, by the inverse mapping of the model's own pieces."""

    def __init__(self, model: bytes):
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        unknown = processor.unk_id()
        self.pieces = [
            b"" if n == unknown or processor.is_unused(n) else as_bytes(processor.id_to_piece(n))
            for n in range(processor.get_piece_size())
        ]

    def text(self, ids: bytes) -> bytes:
        numbers = memoryview(ids).cast("I") if ids else ()
        return b"".join(map(self.pieces.__getitem__, numbers))


@lru_cache(maxsize=2)
def _encoder(model: bytes, spec: tuple[str, str, str, str]) -> _Encoder:
    return _Encoder(model, spec)


@lru_cache(maxsize=2)
def _decoder(model: bytes) -> _Decoder:
    return _Decoder(model)


def encode(df: DataFrame, model: bytes, spec: tuple[str, str, str, str], text: str = "text", ids: str = "ids") -> DataFrame:
    """Add `ids`: the token ids of the whole text as binary, little-endian unsigned 32-bit each.

    Null and empty texts give empty binary. Very long texts are split into pre-tokens list by list. Rows are independent,
    so repeated rows give repeated results, an empty table an empty one, and all other columns pass through. The model
    (about 1 MB for 50,000 pieces, bounded by the vocabulary) travels with the tasks.
    """
    shared = df.sparkSession.sparkContext.broadcast((model, spec))

    def apply(texts: list) -> list[list[bytes]]:
        encoder = _encoder(*shared.value)
        return [[encoder.ids(t or "") for t in texts]]

    return map_texts(df, text, [(ids, T.BinaryType(), pa.binary())], apply)


def decode(df: DataFrame, model: bytes, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add `decoded`: the bytes that the ids stand for. Null ids give empty bytes; an unknown id is an error."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def apply(values: list) -> list[list[bytes]]:
        decoder = _decoder(shared.value)
        return [[decoder.text(v or b"") for v in values]]

    return map_texts(df, ids, [(decoded, T.BinaryType(), pa.binary())], apply)


def digests(docs: DataFrame, model: bytes, spec: tuple[str, str, str, str]) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document: encoded, then decoded from the ids alone."""
    encoded = encode(docs.select("doc_id", "text"), model, spec).select("doc_id", "ids")
    return decode(encoded, model).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def model_and_spec(path: str, pattern: str) -> tuple[bytes, tuple[str, str, str, str]]:
    """What `encode` and `decode` need, from a rank file."""
    return sentencepiece_model(read_ranks(path)), split_spec(pattern)
