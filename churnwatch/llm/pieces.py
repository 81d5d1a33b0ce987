"""SentencePiece encoding and decoding with spans in the original text.

A text is normalised by the model's compiled character map: at every place the longest
prefix in the map is replaced, and each character of the result keeps the byte offset of
its source. The normalised text is cut into pieces by the library, whose own normalisation is
switched off, and every piece's ends are projected back through the alignment.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnwatch.session import ready_python

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MODEL_LIMIT = 16 << 20  # bytes; the model is broadcast, so its size is checked
SPACE = "▁"  # FIXED VALUE: stands for a space inside pieces
# FIXED VALUES: kinds of pieces in a model file
UNKNOWN, CONTROL, USER, BYTE = 2, 3, 4, 6


@dataclass(frozen=True)
class Model:
    """What a model file says: pieces by id, how text is normalised, and the model that takes text as it is."""

    pieces: list[str]
    kinds: list[int]
    charsmap: bytes
    dummy_prefix: bool
    remove_extra: bool
    escape: bool
    suffix: bool
    unknown: str
    plain: bytes


def load_model(path: str = MODEL) -> Model:
    """Reads a model file where the driver runs. Models need byte fallback and no user-defined pieces."""
    from sentencepiece import sentencepiece_model_pb2

    with open(path, "rb") as f:
        content = f.read(MODEL_LIMIT + 1)
    if len(content) > MODEL_LIMIT:
        raise ValueError(f"{path} is larger than {MODEL_LIMIT} bytes")
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(content)
    kinds = [p.type for p in proto.pieces]
    if not proto.trainer_spec.byte_fallback or USER in kinds:
        raise ValueError("only models with byte fallback and without user-defined pieces are read")
    rule = proto.normalizer_spec
    said = rule.precompiled_charsmap, rule.add_dummy_prefix, rule.remove_extra_whitespaces, rule.escape_whitespaces
    rule.name, rule.precompiled_charsmap = "identity", b""
    rule.add_dummy_prefix = rule.remove_extra_whitespaces = rule.escape_whitespaces = False
    suffix, unknown = proto.trainer_spec.treat_whitespace_as_suffix, proto.trainer_spec.unk_surface
    return Model([p.piece for p in proto.pieces], kinds, *said, suffix, unknown, proto.SerializeToString())


class CharacterMap:
    """The compiled map: a double-array trie over UTF-8 bytes whose values are offsets of replacements."""

    def __init__(self, compiled: bytes):
        size = struct.unpack_from("<I", compiled)[0] if compiled else 0
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist() if size else []
        self.replacements = compiled[4 + size :]
        # bytes on which a key can start; characters of others need no look-up
        self.first = {b for b in range(256) if self.units and self._step(self._children(0), b) is not None}

    def _children(self, node: int) -> int:
        unit = self.units[node]
        return node ^ ((unit >> 10) << ((unit & 512) >> 6))

    def _step(self, base: int, byte: int) -> int | None:
        node = base ^ byte
        return node if node < len(self.units) and self.units[node] & 0x800000FF == byte else None

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Bytes that the longest key at ``at`` takes, and its replacement."""
        found, base = None, self._children(0)
        for end in range(at, len(text)):
            node = self._step(base, text[end])
            if node is None:
                break
            base = self._children(node)
            if self.units[node] >> 8 & 1:
                found = end + 1 - at, self.units[base] & 0x7FFFFFFF
        if found is None:
            return None
        start = found[1]
        return found[0], self.replacements[start : self.replacements.index(0, start)]


def _offsets(text: str) -> np.ndarray:
    """Byte offset of each character in UTF-8, and of the end."""
    if text.isascii():
        return np.arange(len(text) + 1)
    code = np.frombuffer(text.encode("utf-32-le"), "<u4")
    return np.concatenate(([0], np.cumsum(1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000))))


def _lead(byte: int) -> range:
    """The bytes that follow the first byte of a character."""
    return range((byte >= 0xC0) + (byte >= 0xE0) + (byte >= 0xF0))


class Codec:
    """Encodes and decodes by a model; built once per Python worker."""

    def __init__(self, model: Model):
        self.model = m = model
        self.map = CharacterMap(m.charsmap)
        self.cut = sentencepiece.SentencePieceProcessor(model_proto=m.plain).encode
        byte = {i: int(p[3:5], 16) for i, (p, k) in enumerate(zip(m.pieces, m.kinds)) if k == BYTE}
        self.surfaces = [
            bytes([byte[i]]) if k == BYTE else b"" if k == CONTROL else (m.unknown if k == UNKNOWN else p.replace(SPACE, " ")).encode()
            for i, (p, k) in enumerate(zip(m.pieces, m.kinds))
        ]
        self.last_mark = max((i for i, k in enumerate(m.kinds) if k in (UNKNOWN, CONTROL)), default=-1)
        # characters that a piece takes; of a character's byte pieces the last takes it, and the first says which that is
        self.taken = np.array([0 if k == BYTE else len(p) for p, k in zip(m.pieces, m.kinds)], dtype=np.int64)
        self.to_last = np.array([-1 if i not in byte or 0x80 <= byte[i] < 0xC0 else len(_lead(byte[i])) for i in range(len(m.pieces))])

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its characters and its end the byte offset of the source."""
        if not text:
            return "", np.zeros(1, dtype=np.int64)
        if self.map.first:
            parts, sources, total = self._replaced(text.encode())
        else:
            parts, sources = text, _offsets(text)
            sources, total = sources[:-1], int(sources[-1])
        end = total
        if self.model.remove_extra:
            parts, sources, end = self._single_spaces(parts, sources, total)
            if not parts:
                return "", np.array([total])
        space = SPACE if self.model.escape else " "
        if self.model.escape:
            parts = parts.replace(" ", SPACE)
        if self.model.dummy_prefix and not self.model.suffix:
            parts, sources = space + parts, np.concatenate(([sources[0] if self.model.remove_extra else 0], sources))
        elif self.model.dummy_prefix:
            parts, sources = parts + space, np.concatenate((sources, [end]))
        return parts, np.concatenate((sources, [end]))

    def _replaced(self, raw: bytes) -> tuple[str, np.ndarray, int]:
        out, sources, at = [], [], 0
        while at < len(raw):
            found = self.map.longest(raw, at) if raw[at] in self.map.first else None
            if found is None:
                size = 1 + len(_lead(raw[at]))
                found = size, raw[at : at + size]
            new = found[1].decode()
            out.append(new)
            sources += [at] * len(new)
            at += found[0]
        return "".join(out), np.array(sources, dtype=np.int64), at

    def _single_spaces(self, text: str, sources: np.ndarray, total: int) -> tuple[str, np.ndarray, int]:
        """No space at either end and one between words; the end is that of the last word. At the end, the escaped space counts as one."""
        chars = np.frombuffer(text.encode("utf-32-le"), "<u4")
        blank = chars == 32
        keep = ~blank | np.concatenate(([False], ~blank[:-1]))
        kept, end = np.nonzero(keep)[0], total
        solid = np.nonzero(~blank[kept] & ((chars[kept] != ord(SPACE)) | (not self.model.escape)))[0]
        last = int(solid[-1]) + 1 if len(solid) else 0
        if last < len(kept):
            end, kept = int(sources[kept[last]]), kept[:last]
        return "".join(map(chr, chars[kept].tolist())), sources[kept], end

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and the first and one past the last byte of the original text that each piece stands for."""
        normal, sources = self.normalise(text)
        ids = np.array(self.cut(normal), dtype=np.int32)
        taken, step = self.taken[ids], self.to_last[ids]
        at = np.nonzero(step >= 0)[0]
        taken[at + step[at]] = 1
        ends = np.cumsum(taken)
        return ids, sources[ends - taken].astype(np.int32), sources[ends].astype(np.int32)

    def decode(self, ids: list[int]) -> str:
        """The text of the pieces: bytes that are not UTF-8 become U+FFFD one by one, the prefix's space goes."""
        if not ids:
            return ""
        m = self.model
        parts = [self.surfaces[i] for i in ids]
        for k, i in enumerate(ids):  # the space of the prefix; more of them where the model allows no extra spaces
            if not (m.dummy_prefix or m.remove_extra) or m.kinds[i] in (UNKNOWN, BYTE):
                break
            if m.kinds[i] != CONTROL:
                parts[k] = parts[k].removeprefix(b" ")
                if parts[k] or not m.remove_extra:
                    break
        try:
            if min(ids) > self.last_mark:
                return b"".join(parts).decode()
        except UnicodeDecodeError:
            pass
        # only neighbouring byte pieces make up a character
        runs = groupby(range(len(ids)), lambda k: k * (m.kinds[ids[k]] != BYTE) or -1)
        return "".join(c for _, run in runs for c in _by_bytes(b"".join(parts[k] for k in run)))


def _by_bytes(raw: bytes) -> Iterator[str]:
    while raw:
        try:
            yield raw.decode()
            return
        except UnicodeDecodeError as wrong:
            yield raw[: wrong.start].decode() + "�"
            raw = raw[wrong.start + 1 :]


_built: dict[int, Codec] = {}


def _codec(shared) -> Codec:
    if shared.value is not None and id(shared.value) not in _built:
        _built.clear()
        _built[id(shared.value)] = Codec(shared.value)
    return _built[id(shared.value)]


def _with_columns(rows: DataFrame, new: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields), new])


def encode(rows: DataFrame, keep: list[str], text: str = "text", model: str = MODEL, decoded: str | None = None) -> DataFrame:
    """The ``keep`` columns plus ``ids``, ``begins`` and ``ends``: the pieces of each whole text and their byte spans.

    Ids are those the library gives without begin or end ids. A span is the original text's bytes that a piece
    came from; of the byte pieces of one character, and of the pieces that one source character turned into,
    the last holds its span and those before are empty at its start. With ``decoded``, a column of that name holds the
    text that the ids decode to. Null and empty texts have no pieces. Rows are kept as they are, repeated ones
    too; kept columns named like a new one are replaced; an empty table gives no rows.
    """
    spark = rows.sparkSession
    ready_python(spark)
    shared = spark.sparkContext.broadcast(load_model(model))
    new = ["ids", "begins", "ends", *filter(None, [decoded])]
    kept = rows.select(F.col(f"`{text}`").cast("string").alias("ids"), *[F.col(f"`{c}`") for c in keep if c.lower() not in map(str.lower, new)])

    def run(batches):
        codec = _codec(shared)
        for batch in batches:
            found = [codec.encode(t or "") for t in batch.column(0).to_pylist()]
            arrays = [pa.array([f[k] for f in found], pa.list_(pa.int32())) for k in range(3)]
            if decoded:
                arrays.append(pa.array([codec.decode(f[0].tolist()) for f in found], pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *arrays], names=[*batch.schema.names[1:], *new])

    kinds = ", ".join(["ids array<int>, begins array<int>, ends array<int>", *(f"`{n}` string" for n in new[3:])])
    return kept.mapInArrow(run, _with_columns(kept.drop("ids"), kinds))


def decode(rows: DataFrame, ids: str = "ids", name: str = "decoded", model: str = MODEL) -> DataFrame:
    """All columns plus ``name``: the text of each row's ids. Null or no ids give an empty text; a column ``name`` is replaced."""
    spark = rows.sparkSession
    ready_python(spark)
    shared = spark.sparkContext.broadcast(load_model(model))
    kept = rows.drop(name)
    at = kept.columns.index(ids)

    def run(batches):
        codec = _codec(shared)
        for batch in batches:
            texts = [codec.decode(i or []) for i in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, name])

    return kept.mapInArrow(run, _with_columns(kept, f"`{name}` string"))
