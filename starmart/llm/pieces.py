"""SentencePiece encoding and decoding with the place of every piece in the original bytes.

A text is normalised by longest prefixes of the model's compiled character map, noting for every
normalised byte where its source began. Pieces cover the normalised bytes one after another, so their
lengths project each piece to a span of source bytes. Segmentation and decoding are the library's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import package_root

MODEL = "piece_bpe_32k.model"
SPACE = "▁"


def model_bytes(path: str | None = None) -> bytes:
    """The model file, by default the public one; read on the driver and sent along with the task."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(MODEL)
    with open(path, "rb") as file:
        return file.read()


class CharMap:
    """A compiled character map: byte strings and what replaces them, in a double-array trie.

    Layout of the blob: the trie's size in bytes (32 bits), its units (32 bits each), then the
    replacements, each ended by a zero byte; a leaf holds the place of its replacement.
    """

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.replacements = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest entry that starts at ``at``."""
        units = self.units
        if not units:
            return None
        place, found = units[0] >> 10 << (units[0] >> 6 & 8), None
        for i in range(at, len(data)):
            place ^= data[i]
            unit = units[place] if place < len(units) else 0
            if unit & 0x800000FF != data[i]:
                break
            place ^= unit >> 10 << (unit >> 6 & 8)
            if unit >> 8 & 1:
                found = (i + 1 - at, units[place] & 0x7FFFFFFF)
        if found is None:
            return None
        end = self.replacements.index(b"\0", found[1])
        return found[0], self.replacements[found[1] : end]


@dataclass
class Normaliser:
    """The normalisation a model asks for."""

    chars: CharMap
    dummy_prefix: bool = True
    squeeze: bool = False
    escape: bool = True

    def normalise(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and for each of them, and the end, where its source begins."""
        if not self.chars.units and not self.squeeze and self.dummy_prefix and self.escape:
            return self._plain(data)
        mark = SPACE.encode() if self.escape else b" "
        out, source, at = bytearray(), [], 0
        units = list(self._units(data))
        if self.squeeze:  # no spaces at the ends, one between
            while units and units[0][2].strip(b" ") == b"":
                at = units.pop(0)[1]
        if units and self.dummy_prefix:
            out += mark
            source += [at] * len(mark)
        was_space = self.squeeze
        for start, end, new in units:
            if self.squeeze and was_space:
                new = new.lstrip(b" ")
            if new:
                was_space = new.endswith(b" ")
                marked = new.replace(b" ", mark)
                out += marked
                source += [start] * len(marked)
            at = end
        if self.squeeze:
            while out.endswith(mark):
                at = source[len(out) - len(mark)]
                del out[len(out) - len(mark) :]
            source = source[: len(out)]
        return bytes(out), np.array([*source, at], dtype=np.int64)

    def _units(self, data: bytes) -> Iterator[tuple[int, int, bytes]]:
        """Start, end and replacement of each longest prefix, or of one character left as it is."""
        at = 0
        while at < len(data):
            found = self.chars.longest(data, at)
            if found is None:
                first = data[at]
                size = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                found = (size, data[at : at + size])
            yield at, at + found[0], found[1]
            at += found[0]

    def _plain(self, data: bytes) -> tuple[bytes, np.ndarray]:
        if not data:
            return b"", np.zeros(1, dtype=np.int64)
        mark = SPACE.encode()
        values = np.frombuffer(data, np.uint8)
        place = np.arange(len(data))
        place = np.maximum.accumulate(np.where(values & 0xC0 != 0x80, place, 0))
        widths = np.where(values == 0x20, len(mark), 1)
        source = np.concatenate([np.zeros(len(mark), np.int64), np.repeat(place, widths), [len(data)]])
        return mark + data.replace(b" ", mark), source


class Encoder:
    """One model in one worker. Needs byte fallback, so that every byte belongs to some piece."""

    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        spec = proto.normalizer_spec
        if not proto.trainer_spec.byte_fallback:
            raise ValueError("the model has no byte fallback")
        if proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("white space as suffix is not supported")
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.normaliser = Normaliser(
            CharMap(spec.precompiled_charsmap),
            spec.add_dummy_prefix,
            spec.remove_extra_whitespaces,
            spec.escape_whitespaces,
        )
        normal, byte, user = 1, 6, 4
        self.is_byte = np.array([p.type == byte for p in proto.pieces])
        self.widths = np.array(
            [
                1 if p.type == byte else len(p.piece.encode()) if p.type in (normal, user) else 0
                for p in proto.pieces
            ]
        )
        self.ends = (np.array([self.sp.bos_id()], "<u4"), np.array([self.sp.eos_id()], "<u4"))

    def ids(self, text: str) -> np.ndarray:
        """The ids of ``text`` without begin and end."""
        if not text:
            return np.zeros(0, "<u4")
        return np.array(self.sp.encode(text), "<u4")

    def framed(self, ids: np.ndarray) -> np.ndarray:
        return np.concatenate([self.ends[0], ids, self.ends[1]])

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of each piece in the bytes of ``text``."""
        normal, source = self.normaliser.normalise(text.encode())
        ends = np.cumsum(self.widths[ids])
        if len(normal) != (ends[-1] if len(ends) else 0):
            raise AssertionError("pieces do not cover the normalised text")
        return source[ends - self.widths[ids]], source[ends]


_ENCODERS: dict[bytes, Encoder] = {}


def encoder(model: bytes) -> Encoder:
    """The worker's encoder of a model, made once per process."""
    key = hashlib.sha256(model).digest()
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(model)
    return _ENCODERS[key]


def encode_batches(batches: Iterator[pa.RecordBatch], model: bytes) -> Iterator[pa.RecordBatch]:
    enc = encoder(model)
    for batch in batches:
        ids, begins, ends = [], [], []
        for text in batch.column(1).to_pylist():
            own = enc.ids(text)
            begin, end = enc.spans(text, own)
            n = len(text.encode())
            ids.append(enc.framed(own).astype(np.int32))
            begins.append(np.concatenate([[0], begin, [n]]).astype(np.int32))
            ends.append(np.concatenate([[0], end, [n]]).astype(np.int32))
        lists = [pa.array(x, pa.list_(pa.int32())) for x in (ids, begins, ends)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *lists], ["doc_id", "ids", "begins", "ends"])


def decode_batches(batches: Iterator[pa.RecordBatch], model: bytes) -> Iterator[pa.RecordBatch]:
    sp = encoder(model).sp
    for batch in batches:
        texts = [sp.decode(x or []) for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])


def digest_batches(
    batches: Iterator[pa.RecordBatch], model: bytes, with_ids: bool
) -> Iterator[pa.RecordBatch]:
    enc = encoder(model)
    for batch in batches:
        counts, ids_sha, text_sha, tiled, lists = [], [], [], [], []
        for text in batch.column(1).to_pylist():
            own = enc.ids(text)
            begin, end = enc.spans(text, own)
            n = len(text.encode())
            whole = n == 0 or bool(begin[0] == 0 and end[-1] == n and (begin[1:] == end[:-1]).all())
            ids = enc.framed(own)
            counts.append(len(ids))
            ids_sha.append(hashlib.sha256(ids.tobytes()).hexdigest())
            text_sha.append(hashlib.sha256(enc.sp.decode(ids.tolist()).encode()).hexdigest())
            tiled.append(whole)
            if with_ids:
                lists.append(ids.astype(np.int32))
        columns = {
            "doc_id": batch.column(0),
            "n_tokens": pa.array(counts, pa.int64()),
            "ids_sha256": pa.array(ids_sha, pa.string()),
            "decoded_sha256": pa.array(text_sha, pa.string()),
            "spans_tile_text": pa.array(tiled, pa.bool_()),
        }
        if with_ids:
            columns["ids"] = pa.array(lists, pa.list_(pa.int32()))
        yield pa.RecordBatch.from_pydict(columns)


def _mapped(df: DataFrame, function: str, schema: str, *args) -> DataFrame:
    root = package_root()

    def run(batches):
        import sys

        if root not in sys.path:
            sys.path.append(root)
        from starmart.llm import pieces

        yield from getattr(pieces, function)(batches, *args)

    return df.mapInArrow(run, schema)


def _id_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def encode(docs: DataFrame, model: bytes | None = None) -> DataFrame:
    """``doc_id``, ``ids``, ``begins``, ``ends``: pieces with begin and end marks and their byte spans.

    The marks have empty spans at 0 and at the text's end. Null texts count as empty; repeated rows
    are encoded alike; other columns are ignored.
    """
    lists = "ids array<int>, begins array<int>, ends array<int>"
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return _mapped(texts, "encode_batches", f"doc_id {_id_type(docs)}, {lists}", model or model_bytes())


def decode(encoded: DataFrame, model: bytes | None = None) -> DataFrame:
    """``doc_id`` and ``text`` of ``encoded(doc_id, ids)``; null ids give an empty text."""
    own = encoded.select("doc_id", "ids")
    return _mapped(own, "decode_batches", f"doc_id {_id_type(encoded)}, text string", model or model_bytes())


def digest(docs: DataFrame, model: bytes | None = None, ids: bool = False) -> DataFrame:
    """Encode and decode in one pass, returning counts and hashes of ids and texts (and the ids).

    ``doc_id``, ``n_tokens`` (with both marks), ``ids_sha256`` (ids as little-endian 32-bit numbers),
    ``decoded_sha256``, ``spans_tile_text`` (the spans follow each other from the first byte to the
    last). Null texts count as empty and repeated rows are encoded alike; an empty table gives no rows; other
    columns are ignored. The library takes a text whole: a very long one needs some forty bytes a token.
    """
    columns = "n_tokens bigint, ids_sha256 string, decoded_sha256 string, spans_tile_text boolean"
    columns += ", ids array<int>" if ids else ""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    schema = f"doc_id {_id_type(docs)}, {columns}"
    return _mapped(texts, "digest_batches", schema, model or model_bytes(), ids)
