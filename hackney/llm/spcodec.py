"""SentencePiece encoding and decoding on the tokenizers library.

``parse`` reads a model file's protobuf; ``backend`` rebuilds its normaliser
(the compiled character map, blanks, the marker for blanks), its model
(unigram scores, or the merges that a BPE model's scores imply) and byte
fallback as a tokenizers pipeline. ``SentencePieces`` encodes texts with it.

No piece of such a model has a marker after another character (checked when
the model is loaded), so merges never cross the start of a run of markers and
a normalised text's ids are the concatenation of those of its units, each a
run of markers with what follows up to the next. Workers therefore keep a
bounded cache of units and encode what is missing from a batch of documents in
one multithreaded call of the library; a model for which the check fails, and
unigram models, are encoded text by text. Parity is verified against the
sentencepiece library on every unit when it is first encoded (or on every
text, ``verify="texts"``): a document's ``parity`` is false if one differs.

Defined cases: NULL and empty texts have no ids and decode to the empty text;
NULL ids and repeated rows are rows like others; texts are never truncated;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, decoders, models, normalizers

MARKER = "▁"
#: Fixed values of the format: types of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2

#: Units a worker's cache holds before it starts anew, and the longest it stores.
CACHE_UNITS = 400_000
CACHED_CHARS = 48
#: Characters of the texts that are split into units at once.
SPLIT_CHARS = 1_000_000

_UNIT = re.compile(f"{MARKER}*[^{MARKER}]+|{MARKER}+")


@dataclass
class Model:
    """What a model file says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    marker_as_suffix: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    merge_blanks: bool = True
    escape_blanks: bool = True


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field number and value of each field of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        wire = tag & 7
        if wire == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}[wire] if wire != 2 else varint()
        yield tag >> 3, data[at:at + size]
        at += size


def parse(data: bytes) -> Model:
    """The parts of a model file that encoding depends on."""
    model = Model()
    for number, value in _fields(data):
        if number == 1:
            parts = dict(_fields(value))
            model.pieces.append((parts.get(1, b"").decode(), struct.unpack("<f", parts.get(2, bytes(4)))[0],
                                 parts.get(3, NORMAL)))
        elif number == 2:
            for n, v in _fields(value):
                if n == 3:
                    model.kind = v
                elif n == 24:
                    model.marker_as_suffix = bool(v)
                elif n == 35:
                    model.byte_fallback = bool(v)
        elif number == 3:
            for n, v in _fields(value):
                if n == 2:
                    model.charsmap = v
                elif n == 3:
                    model.dummy_prefix = bool(v)
                elif n == 4:
                    model.merge_blanks = bool(v)
                elif n == 5:
                    model.escape_blanks = bool(v)
    return model


def merges(model: Model) -> list[tuple[str, str]]:
    """The pairs a BPE model joins, by falling score of what they form."""
    usable = {p: score for p, score, kind in model.pieces if kind in (NORMAL, USER_DEFINED, UNUSED)}
    place = {p: i for i, (p, _, _) in enumerate(model.pieces)}
    found = [(-score, place[p], p[:k], p[k:]) for p, score in usable.items()
             for k in range(1, len(p)) if p[:k] in usable and p[k:] in usable]
    return [(left, right) for _, _, left, right in sorted(found, key=lambda m: (m[0], m[1], place[m[2]], place[m[3]]))]


def backend(model: Model) -> Tokenizer:
    """A tokenizers pipeline that encodes as the model does."""
    if model.kind not in (UNIGRAM, BPE) or model.marker_as_suffix or not model.escape_blanks:
        raise ValueError("only unigram and BPE models with markers before words are supported")
    unknown = next(i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN)
    if model.kind == BPE:
        vocabulary = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        core = models.BPE(vocabulary, merges(model), unk_token=model.pieces[unknown][0], fuse_unk=True,
                          byte_fallback=model.byte_fallback)
    else:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], unknown, model.byte_fallback)
    pipeline = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.merge_blanks:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARKER))
    pipeline.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARKER)])
    pipeline.decoder = decoders.Sequence([decoders.Replace(MARKER, " "), decoders.ByteFallback(), decoders.Fuse()]
                                         + [decoders.Strip(" ", 1, 0)] * model.dummy_prefix)
    return pipeline


class SentencePieces:
    """Encodes and decodes batches of texts; keeps a bounded cache of units."""

    def __init__(self, data: bytes, verify: str = "units", cache_units: int = CACHE_UNITS):
        self.model = parse(data)
        self.pipeline = backend(self.model)
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.verify, self.limit = verify, cache_units
        inner = re.compile(f"[^{MARKER}]{MARKER}")
        self.by_unit = (self.model.kind == BPE and self.model.dummy_prefix
                        and not any(k != CONTROL and inner.search(p) for p, _, k in self.model.pieces))
        self.plain = not self.model.charsmap and not self.model.merge_blanks
        self.units = Tokenizer(self.pipeline.model)
        self._ids: dict[str, bytes] = {}
        self._odd: set[str] = set()  # cached units on which the libraries differ
        self._bytes = [bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL
                       else " ⁇ ".encode() if kind == UNKNOWN else p.encode()
                       for p, _, kind in self.model.pieces]

    def normalise(self, text: str) -> str:
        if not text:
            return ""
        if self.plain:
            return MARKER * self.model.dummy_prefix + text.replace(" ", MARKER)
        return self.pipeline.normalizer.normalize_str(text)

    def encode(self, texts: list[str]) -> list[tuple[bytes, bool | None]]:
        """The ids of each text (little-endian unsigned 32-bit) and whether both libraries agree."""
        if not self.by_unit or self.verify == "texts":
            found = [e.ids for e in self.pipeline.encode_batch(texts, add_special_tokens=False)]
            agree = ([a == b for a, b in zip(found, self.reference.encode(texts, num_threads=1), strict=True)]
                     if self.verify else [None] * len(texts))
            return [(np.array(ids, "<u4").tobytes(), same) for ids, same in zip(found, agree, strict=True)]
        out, at = [], 0
        while at < len(texts):  # a few texts at a time: their units are small strings
            to, chars = at, 0
            while to < len(texts) and (to == at or chars + len(texts[to]) <= SPLIT_CHARS):
                chars += len(texts[to])
                to += 1
            out += self._encode_units(texts[at:to])
            at = to
        return out

    def _encode_units(self, texts: list[str]) -> list[tuple[bytes, bool | None]]:
        split = [self._split(self.normalise(t)) for t in texts]
        known = self._ids
        missing = sorted({u for units in split for u in units if u not in known})
        if len(known) + len(missing) > self.limit:
            known.clear()
            self._odd.clear()
            missing = sorted({u for units in split for u in units})
        odd = set()
        for unit, got in zip(missing, self.units.encode_batch_fast(missing, add_special_tokens=False), strict=True):
            known[unit] = np.array(got.ids, "<u4").tobytes()
        if self.verify and missing:
            # The library puts the first marker itself.
            for unit, ids in zip(missing, self.reference.encode([u[1:] for u in missing], num_threads=1), strict=True):
                if np.array(ids, "<u4").tobytes() != known[unit] and len(unit) > 1:
                    odd.add(unit)
        self._odd |= odd
        out = [(b"".join(map(known.__getitem__, units)),
                (not self._odd or self._odd.isdisjoint(units)) if self.verify else None) for units in split]
        for unit in [u for u in missing if len(u) > CACHED_CHARS]:
            del known[unit]
            self._odd.discard(unit)
        return out

    @staticmethod
    def _split(normal: str) -> list[str]:
        if MARKER * 2 in normal or normal.endswith(MARKER) or not normal.startswith(MARKER):
            return _UNIT.findall(normal)
        return [MARKER + word for word in normal.split(MARKER)[1:]]

    def decode(self, ids: bytes) -> str:
        """The text of ids, as the library decodes: without the marker of the first word."""
        raw = b"".join(map(self._bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        text = raw.decode("utf-8", "replace").replace(MARKER, " ")
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


_WORKER: dict[tuple, SentencePieces] = {}


def of_worker(data: bytes, verify: str | None) -> SentencePieces:
    key = (hash(data), verify)
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = SentencePieces(data, verify)
    return _WORKER[key]


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
           verify: str | None = "units", with_ids: bool = True, threads: int = 1) -> DataFrame:
    """One row per document: id, n_tokens, ids_crc32, round_trip, parity (and ids as binary).

    ``round_trip`` says that decoding the ids gives the normalised text, with
    markers as blanks. ``threads`` is what one task gives the library: as many
    as ``spark.task.cpus``. The model file is read on the driver and broadcast.
    """
    with open(model_path, "rb") as file:
        data = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        codec = of_worker(data.value, verify)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            encoded = codec.encode(texts)
            same = [codec.decode(ids) == codec.normalise(text).replace(MARKER, " ")[codec.model.dummy_prefix:]
                    for text, (ids, _) in zip(texts, encoded, strict=True)]
            columns = [batch.column(0), pa.array([len(ids) // 4 for ids, _ in encoded], pa.int64()),
                       pa.array([zlib.crc32(ids) for ids, _ in encoded], pa.int64()), pa.array(same, pa.bool_()),
                       pa.array([agree for _, agree in encoded], pa.bool_())]
            names = ["id", "n_tokens", "ids_crc32", "round_trip", "parity"]
            if with_ids:
                columns.append(pa.array([ids for ids, _ in encoded], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, n_tokens long, ids_crc32 long, round_trip boolean, parity boolean"
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, schema + ", ids binary" * with_ids).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row of ``encoded``: id and the decoded text (NULL ids: empty)."""
    with open(model_path, "rb") as file:
        data = encoded.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = of_worker(data.value, None)
        for batch in batches:
            texts = [codec.decode(ids or b"") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    id_type = encoded.schema[id_col].dataType.simpleString()
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"id {id_type}, text string").withColumnRenamed("id", id_col)
