"""SentencePiece encoding and decoding with the tokenizers library.

The model file's protobuf is parsed here: pieces with scores and types, the
model type, the normaliser's settings and character map.  From these a tokenizer
is rebuilt: normaliser (character map, extra white space, dummy prefix, escaping
of spaces by the metaspace marker), the unigram scores or, for a BPE model, the
merges in the order of the scores, and byte fallback.

Encoding: whole raw texts go to the rebuilt tokenizer in multithreaded batches;
its ids are the result.  Parity: the same raw texts are encoded by the
sentencepiece library with the unmodified model, and documents whose ids differ
are counted (``n_differ``).  Round trip: the ids are joined to text again and
compared with the normalised text.

Memory: a task holds texts of about 1 MB at a time.  Where no piece has a marker
behind another character, a text over SEGMENT characters is encoded in segments
cut at single spaces, which stand for the dummy prefix of the next; the ids are
the same.  A text of another model is encoded whole.

Defined cases: null text has null ids and 0 tokens; empty text has no ids;
repeated rows come out once each; an empty table gives an empty result; columns
named like an output column are replaced by it.
"""

from __future__ import annotations

import os
import re
import struct
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import map_arrow

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
#: characters of a text's segment; bytes of text encoded at once
SEGMENT, BATCH_BYTES = 1 << 17, 1 << 20
OUTPUTS = ("token_ids", "n_tokens", "n_differ", "roundtrip")


def _fields(data: bytes):
    """(number, value) of a protobuf message: ints, bytes and 4-byte floats."""
    def varint(at):
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 1:
            value, at = data[at:at + 8], at + 8
        elif kind == 2:
            size, at = varint(at)
            value, at = data[at:at + size], at + size
        elif kind == 5:
            value, at = struct.unpack("<f", data[at:at + 4])[0], at + 4
        else:
            raise ValueError(f"wire type {kind} in a model file")
        yield tag >> 3, value


class Spec:
    """What a SentencePiece model file says."""

    def __init__(self, data: bytes):
        self.pieces, self.scores, self.types = [], [], []
        trainer, normaliser = {}, {}
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode("utf-8"))
                self.scores.append(piece.get(2, 0.0))
                self.types.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normaliser = dict(_fields(value))
        self.kind = {1: "unigram", 2: "bpe"}.get(trainer.get(3, 1))
        if self.kind is None:
            raise ValueError("only unigram and BPE models are supported")
        self.byte_fallback = bool(trainer.get(35, 0))
        self.unknown = self.types.index(UNKNOWN)
        self.charsmap = normaliser.get(2, b"")
        self.dummy_prefix = bool(normaliser.get(3, 1))
        self.squeeze = bool(normaliser.get(4, 1))
        self.escape = bool(normaliser.get(5, 1))
        #: a text may be split before every run of markers
        self.splits = self.escape and all(
            re.fullmatch(f"{MARK}*[^{MARK}]*", p) for p, t in zip(self.pieces, self.types) if t == NORMAL)


def build(spec: Spec):
    """The tokenizers-library tokenizer of already normalised, escaped text."""
    from tokenizers import Tokenizer, models
    ids = {p: i for i, p in enumerate(spec.pieces)}
    if spec.kind == "unigram":
        return Tokenizer(models.Unigram(list(zip(spec.pieces, spec.scores)), unk_id=spec.unknown,
                                        byte_fallback=spec.byte_fallback))
    usable = {p for p, t in zip(spec.pieces, spec.types) if t in (NORMAL, USER)}
    ranked = sorted((i for i, t in enumerate(spec.types) if t == NORMAL and len(spec.pieces[i]) > 1),
                    key=lambda i: (-spec.scores[i], i))
    merges = []
    for i in ranked:
        p = spec.pieces[i]
        halves = [(p[:k], p[k:]) for k in range(1, len(p)) if p[:k] in usable and p[k:] in usable]
        merges += sorted(halves, key=lambda h: (ids[h[0]], ids[h[1]]))
    return Tokenizer(models.BPE(vocab=ids, merges=merges, unk_token=spec.pieces[spec.unknown],
                                fuse_unk=True, byte_fallback=spec.byte_fallback))


class Codec:
    """Encoder and decoder of one worker."""

    def __init__(self, data: bytes):
        # the tokenizers library reads its thread count once; tasks share the machine's cores
        os.environ.setdefault("RAYON_NUM_THREADS", "2")
        import sentencepiece
        from tokenizers import normalizers
        self.spec = Spec(data)
        self.tokenizer = build(self.spec)
        self.normaliser = normalizers.Sequence(self._normaliser(normalizers))
        #: the sentencepiece library's own processor, as the model file has it
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.plain = self.spec.escape and self.spec.dummy_prefix and not self.spec.squeeze and not self.spec.charsmap
        #: a text may be cut at single spaces
        self.cuts = self.plain and self.spec.splits
        self.bytes_of = {i: int(p[3:5], 16) for i, (p, t) in enumerate(zip(self.spec.pieces, self.spec.types)) if t == BYTE}

    def _normaliser(self, normalizers) -> list:
        s, steps = self.spec, []
        if s.charsmap:
            steps.append(normalizers.Precompiled(s.charsmap))
        if s.squeeze:
            from tokenizers import Regex
            steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" +"), " ")]
        if s.dummy_prefix:
            steps.append(normalizers.Prepend(MARK if s.escape else " "))
        if s.escape:
            steps.append(normalizers.Replace(" ", MARK))
        return steps

    def normalise(self, text: str) -> str:
        """The text whose pieces are looked up."""
        if self.plain:  # only the dummy prefix and the marker
            return MARK + text.replace(" ", MARK) if text else ""
        return self.normaliser.normalize_str(text) if text else ""

    def segments(self, text: str) -> list[str]:
        """The text, or consecutive parts of it if it is long: each single space
        at a cut is left out, as the dummy prefix of the next part puts it back."""
        out, at = [], 0
        while self.cuts and len(text) - at > SEGMENT:
            end = text.find(" ", at + SEGMENT)
            while end > 0 and (text[end - 1] in (" ", MARK) or text[end + 1:end + 2] in (" ", "")):
                end = text.find(" ", end + 1)
            if end < 0:
                break
            out.append(text[at:end])
            at = end + 1
        return [*out, text[at:]]

    def encode(self, texts: list):
        """(ids of all texts, ids per text, 1 for a text on which the libraries
        differ, round trip per text); null counts as empty."""
        parts = [self.segments(t or "") for t in texts]
        flat = [p for ps in parts for p in ps]
        normal = [self.normalise(p) for p in flat]
        got = [e.ids for e in self.tokenizer.encode_batch_fast(normal, add_special_tokens=False)]
        size = np.fromiter(map(len, got), np.int64, len(got))
        ids = np.fromiter(chain.from_iterable(got), np.int32, int(size.sum()))
        del got  # a Python int per token
        want = self.reference.encode(flat, num_threads=2, out_type="numpy") if flat else []
        text = np.repeat(np.arange(len(texts)), [len(ps) for ps in parts])
        ends = np.cumsum(size).tolist()
        some = lambda bad: np.bincount(text, weights=bad, minlength=len(texts)).astype(np.int64) > 0
        differ = some([not np.array_equal(ids[s:e], w) for s, e, w in zip([0, *ends], ends, want)])
        return (ids, np.bincount(text, weights=size, minlength=len(texts)).astype(np.int64), differ.astype(np.int64),
                ~some(self._lost(ids, size, normal)))

    def _lost(self, ids: np.ndarray, size: np.ndarray, normal: list[str]) -> np.ndarray:
        """Per text, whether its joined pieces are not the text."""
        joined = self._piece_bytes.take(pa.array(ids, pa.int32()))
        _, offsets, data = joined.buffers()
        at = np.frombuffer(offsets, np.int64, len(ids) + 1) if len(ids) else np.zeros(1, np.int64)
        ends = at[np.concatenate([[0], np.cumsum(size)]).astype(np.int64)].tolist()
        data = data.to_pybytes() if data else b""
        return np.array([data[s:e] != t.encode("utf-8", "replace") for s, e, t in zip(ends, ends[1:], normal)], bool)

    @cached_property
    def _piece_bytes(self) -> pa.LargeBinaryArray:
        return pa.array(self._raw_pieces(), pa.large_binary())

    def decode(self, ids) -> str:
        """Text of a sequence of ids."""
        text = self.joined(ids)
        if self.spec.escape:
            text = text.replace(MARK, " ")
        return text[1:] if self.spec.dummy_prefix and text.startswith(" ") else text

    def joined(self, ids) -> str:
        """Pieces of ids joined, byte pieces as the bytes they stand for."""
        return b"".join(map(self._raw_pieces().__getitem__, ids)).decode("utf-8", "replace")

    def _raw_pieces(self) -> list[bytes]:
        if not hasattr(self, "_table"):
            self._table = [bytes([self.bytes_of[i]]) if i in self.bytes_of else b"" if t == CONTROL
                         else (" ⁇ " if self.bytes_of and t == UNKNOWN else p).encode()
                         for i, (p, t) in enumerate(zip(self.spec.pieces, self.spec.types))]
        return self._table


_codecs: dict[bytes, Codec] = {}


def codec(data: bytes) -> Codec:
    """The worker's codec of a model (built once)."""
    if data not in _codecs:
        _codecs.clear()
        _codecs[data] = Codec(data)
    return _codecs[data]


def _model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model: str = MODEL, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, plus token_ids, n_tokens, n_differ (1 if the
    sentencepiece library encodes the text otherwise) and roundtrip (decoding
    gives the normalised text; null for null).  ``model``: a path on the driver."""
    rest = [c for c in docs.columns if c not in (text_col, *OUTPUTS)]
    at = docs.sparkSession.sparkContext.broadcast(_model(model))  # the model file: bounded

    def run(batches):
        own = codec(at.value)
        for b in batches:
            col, start = b.column(b.num_columns - 1), 0
            while start < len(col):
                stop, size = start, 0
                while stop < len(col) and (stop == start or size < BATCH_BYTES):
                    size += len(col[stop].as_buffer() or b"") if col[stop].is_valid else 0
                    stop += 1
                texts = col.slice(start, stop - start).to_pylist()
                ids, per, differ, same = own.encode(texts)
                null = np.array([t is None for t in texts], bool)
                offsets = pa.array(np.concatenate([[0], np.cumsum(per)]).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids), mask=pa.array(null))
                yield pa.RecordBatch.from_arrays(
                    [*b.slice(start, stop - start).columns[:-1], lists, pa.array(per), pa.array(differ),
                     pa.array(same, mask=null)],
                    names=[*b.schema.names[:-1], "token_ids", "n_tokens", "n_differ", "roundtrip"])
                start = stop

    schema = docs.select(*rest, F.array(F.lit(0)).alias("token_ids"), F.lit(0).cast("long").alias("n_tokens"),
                         F.lit(0).cast("long").alias("n_differ"), F.lit(True).alias("roundtrip")).schema
    for f in schema.fields[-4:]:
        f.nullable = True
    return map_arrow(docs.select(*rest, F.col(text_col).alias("__text")), run, schema)


def decode(rows: DataFrame, model: str = MODEL, ids_col: str = "token_ids", text_col: str = "text") -> DataFrame:
    """``rows`` with the ids replaced by their text (null for null)."""
    rest = [c for c in rows.columns if c not in (ids_col, text_col)]
    at = rows.sparkSession.sparkContext.broadcast(_model(model))

    def run(batches):
        own = codec(at.value)
        for b in batches:
            text = [None if x is None else own.decode(x) for x in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(text, pa.string())],
                                             names=[*b.schema.names[:-1], text_col])

    return map_arrow(rows.select(*rest, F.col(ids_col).alias("__ids")), run,
                     rows.select(*rest).schema.add(text_col, "string"))
