"""Chat formatting by token-level assembly.

Every segment (a role or a text) is encoded on its own; the template's marks are reserved
ids spliced between segments, so no text can produce one. The same marks exist as strings
in the readable form, therefore their strings inside a text are escaped: a backslash goes
in after the first character (and after any backslashes already there), which reading
back takes out again. Loss masks come from prefix sums over segment lengths.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnwatch.session import ready_python

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
TOKENIZER_LIMIT = 16 << 20  # bytes; the file is broadcast, so its size is checked
# FIXED VALUE: the pre-tokenisation pattern that belongs to the vocabulary file
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# FIXED VALUES: template marks, in the order of their reserved ids
MARKS = ["<s>", "</s>", "[INST]", "[/INST]", "[ASST]", "[ROLE]", "[TEXT]", "[/ROLE]"]
BOS, END, USER, USER_END, ASSISTANT, ROLE, TEXT, ROLE_END = range(len(MARKS))
LONG_SPACE = 1 << 18  # a longer run of white space is more than the library's pattern engine takes; same ids without it

_ESCAPE = re.compile("|".join(rf"(?<={re.escape(m[0])})(?=\\*{re.escape(m[1:])})" for m in MARKS))
_UNESCAPE = re.compile("|".join(rf"(?<={re.escape(m[0])})\\(?=\\*{re.escape(m[1:])})" for m in MARKS))
_SPACE = re.compile(r"[^\S\x1c-\x1f]+")  # white space as the vocabulary's pattern knows it


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\\", text) if "<" in text or "[" in text else text


def unescape(text: str) -> str:
    return _UNESCAPE.sub("", text) if "\\" in text else text


class Codec:
    """A byte-level vocabulary with the marks' ids above it."""

    _built: dict[str, Codec] = {}

    def __init__(self, file: bytes):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file.splitlines())}
        self.ranks = ranks
        self.encoding = tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.first = max(ranks.values()) + 1

    @classmethod
    def of(cls, file: bytes) -> Codec:
        name = hashlib.sha256(file).hexdigest()
        if name not in cls._built:
            cls._built[name] = cls(file)
        return cls._built[name]

    @cached_property
    def unsplit(self) -> tiktoken.Encoding:
        """The same vocabulary for a text that is one pre-token."""
        return tiktoken.Encoding("unsplit", pat_str=r"[\s\S]+", mergeable_ranks=self.ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        """The ids of the whole text, as the library gives them.

        White space up to the last one before a word is one pre-token by the pattern, so a
        run that is too long for its engine is encoded alone and the text around it as usual.
        """
        if len(text) <= LONG_SPACE:
            return self.encoding.encode_ordinary(text)
        out, done = [], 0
        for run in _SPACE.finditer(text):
            if run.end() - run.start() > LONG_SPACE:
                end = run.end() - (run.end() < len(text))
                out += self.encoding.encode_ordinary(text[done : run.start()])
                out += self.unsplit.encode_ordinary(text[run.start() : end])
                done = end
        return out + self.encoding.encode_ordinary(text[done:])

    def decode(self, ids: list[int]) -> str:
        return self.encoding.decode_bytes(ids).decode()

    def turn(self, role: str, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids and loss mask of one turn; only an assistant's text is under the mask."""
        body = self.encode(escape(text))
        if role == "user":
            parts = [([USER], 0), (body, 0), ([USER_END], 0)]
        elif role == "assistant":
            parts = [([ASSISTANT], 0), (body, 1), ([END], 0)]
        else:
            parts = [([ROLE], 0), (self.encode(escape(role)), 0), ([TEXT], 0), (body, 0), ([ROLE_END], 0)]
        ids = np.array([i for p, _ in parts for i in p], dtype=np.int32)
        ends = np.cumsum([len(p) for p, _ in parts])
        ids[ends[::2] - 1] += self.first  # every other part is one mark
        step = np.zeros(len(ids) + 1, dtype=np.int8)
        for (p, loss), end in zip(parts, ends):
            step[end - len(p)] += loss
            step[end] -= loss
        return ids, np.cumsum(step[:-1], dtype=np.int8).astype(bool)

    def read(self, ids: np.ndarray, loss: np.ndarray) -> tuple[str, str, str, str]:
        """Role, text, text under the mask and the readable form of one turn's tokens."""
        at = np.nonzero(ids >= self.first)[0]
        marks = (ids[at] - self.first).tolist()
        texts = [self.decode(ids[a + 1 : b].tolist()) for a, b in zip(at, [*at[1:], len(ids)])]
        readable = "".join(MARKS[m] + t for m, t in zip(marks, texts))
        kinds = [(m, t) for m, t in zip(marks, texts) if m != BOS]
        head = kinds[0][0]
        role = "user" if head == USER else "assistant" if head == ASSISTANT else unescape(kinds[0][1])
        body = kinds[1][1] if head == ROLE else kinds[0][1]
        masked = unescape(self.decode(ids[loss].tolist()))
        return role, unescape(body), masked, readable


def load_tokenizer(path: str = TOKENIZER) -> bytes:
    """The vocabulary file, read where the driver runs; executors get it by broadcast."""
    with open(path, "rb") as f:
        file = f.read(TOKENIZER_LIMIT + 1)
    if len(file) > TOKENIZER_LIMIT:
        raise ValueError(f"{path} is larger than {TOKENIZER_LIMIT} bytes")
    return file


def format_conversations(rows: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per turn: ``conv_id, place, start, ids, loss``.

    ``rows`` has ``conv_id, turn, role, text``; other columns are not read. Turns are
    numbered by ``place`` in order of turn (null first; ties by role, then by a hash of the text, so
    repeated rows stay, each a turn), ``start`` is the turn's first token in its
    conversation, ``ids``/``loss`` its tokens and mask; the first turn carries the opening
    mark. Null role or text is empty, a null conv_id is a conversation of its own, an
    empty table gives no rows. Turns are encoded wherever they lie; only their order is
    made per conversation, as a running sum over sorted rows that holds one turn at a time.
    """
    spark = rows.sparkSession
    ready_python(spark)
    file = spark.sparkContext.broadcast(load_tokenizer(tokenizer))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(file.value)
        for batch in batches:
            turns = [codec.turn(r or "", t or "") for r, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], batch.column(4), pa.array([i for i, _ in turns], pa.list_(pa.int32())), pa.array([m for _, m in turns], pa.list_(pa.bool_()))],
                names=["conv_id", "turn", "role", "h", "ids", "loss"],
            )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = Codec.of(file.value).first
        last, n, start = object(), 0, 0
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for conv, ids, loss in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                ids, loss = ids.values.to_numpy(), loss.values.to_numpy(zero_copy_only=False)
                if conv != last:
                    last, n, start = conv, 0, 0
                    ids, loss = np.concatenate(([first + BOS], ids)).astype(np.int32), np.concatenate(([False], loss))
                for column, x in zip(out, (conv, n, start, ids, loss)):
                    column.append(x)
                n, start = n + 1, start + len(ids)
            kinds = (batch.schema.field(0).type, pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.bool_()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["conv_id", "place", "start", "ids", "loss"])

    kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    encoded = rows.select("conv_id", "turn", F.col("role").cast("string"), F.col("text").cast("string"), F.xxhash64("text").alias("h")).mapInArrow(
        encode, f"conv_id {kind['conv_id']}, turn {kind['turn']}, role string, h long, ids array<int>, loss array<boolean>"
    )
    ordered = encoded.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "h")
    return ordered.select("conv_id", "ids", "loss").mapInArrow(
        place, f"conv_id {kind['conv_id']}, place long, start long, ids array<int>, loss array<boolean>"
    )


def digests(formatted: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Reads formatted tokens back: per conversation the digests of its turns and of the text under the mask.

    Rows are decoded from ids alone, in place order; hashes run over the stream, so a
    conversation of any length needs the memory of one batch.
    """
    ready_python(formatted.sparkSession)
    file = formatted.sparkSession.sparkContext.broadcast(load_tokenizer(tokenizer))
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens", "n_loss_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(file.value)
        key, state, done, kind = None, None, [], None

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done))
            done.clear()
            kinds = (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        def close() -> None:
            n, turns, chars, loss, size, tokens, masked = state
            done.append((key, n, turns.hexdigest(), chars, loss.hexdigest(), size, tokens, masked))

        for batch in batches:
            kind = batch.schema.field(0).type
            for conv, ids, loss in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                ids, loss = ids.values.to_numpy(), loss.values.to_numpy(zero_copy_only=False)
                if state is None or conv != key:
                    if state is not None:
                        close()
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                role, text, masked, readable = codec.read(ids, loss)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(masked)
                state[3].update(masked.encode())
                state[4] += len(readable)
                state[5] += len(ids)
                state[6] += int(loss.sum())
            if len(done) >= 4096:
                yield flush()
        if state is not None:
            close()
        if done:
            yield flush()

    kind = formatted.schema["conv_id"].dataType.simpleString()
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "place").select("conv_id", "ids", "loss")
    return ordered.mapInArrow(
        run,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long, n_loss_tokens long",
    )
