"""Byte-level BPE: text to ids and ids to bytes with a local rank file.

The library gets whole texts. Only a text of more than ``LONG`` characters is cut,
each time at the first safe place past that length: before white space that
follows a non-space, or between a letter or digit and another kind of character
(marks excepted). No match of the splitting pattern crosses such a place, and its
look-ahead only looks at what follows white space, so the cuts change nothing.

A null text is the empty text (no ids); repeated rows are encoded each, and an
empty table gives one. A text is held whole with its ids, other texts of its batch
only up to ``slices``' limit. Only the columns named by the caller and the text
are read.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillwright.llm.common import slices

# The code points with the Unicode property White_Space.
WHITE = " \t\n\x0b\x0c\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SAFE = regex.compile(rf"(?<=[^{WHITE}])(?=[{WHITE}])|(?<=\p{{L}})(?=[^\p{{L}}\p{{M}}])|(?<=\p{{N}})(?=[^\p{{N}}\p{{M}}])")
LONG = 1 << 16


def rank_bytes(path: str) -> bytes:
    """The rank file as it lies on the driver; tens of thousands of short lines, about 1 MB."""
    with open(path, "rb") as file:
        return file.read()


def _ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in raw.splitlines() if line.strip())}


def chunks(text: str, limit: int = LONG) -> Iterator[str]:
    """``text`` cut at safe places, ``limit`` characters apart at least; a stretch without such a place stays whole."""
    start = 0
    while len(text) - start > limit:
        found = SAFE.search(text, start + limit)
        if not found:
            break
        yield text[start:found.start()]
        start = found.start()
    yield text[start:]


def encoding_of(ranks: dict[bytes, int], pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(1)
def _encoding(raw: bytes, pattern: str) -> tiktoken.Encoding:
    return encoding_of(_ranks(raw), pattern)


class Tokens:
    """The bytes of all tokens in one buffer; the token of id i lies from ``starts[i]`` and is ``sizes[i]`` long."""

    def __init__(self, tokens: dict[int, bytes]):
        width = max(tokens, default=-1) + 1
        self.sizes = np.zeros(width, np.int64)
        self.sizes[list(tokens)] = [len(t) for t in tokens.values()]
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.buffer = np.frombuffer(b"".join(tokens[i] for i in sorted(tokens)), np.uint8)

    def joined(self, ids: np.ndarray) -> bytes:
        sizes = self.sizes[ids]
        place = np.arange(sizes.sum()) + np.repeat(self.starts[ids] - (np.cumsum(sizes) - sizes), sizes)
        return self.buffer[place].tobytes()


@functools.lru_cache(1)
def _tokens(raw: bytes) -> Tokens:
    return Tokens({rank: token for token, rank in _ranks(raw).items()})


def ids_of(encoding: tiktoken.Encoding, text: str, limit: int = LONG) -> np.ndarray:
    """The ids of the text; strings of special tokens are plain text."""
    return np.concatenate([np.asarray(encoding.encode_ordinary(part), np.int32) for part in chunks(text, limit)])


def encode_text(text: str, raw: bytes, pattern: str, limit: int = LONG) -> np.ndarray:
    return ids_of(_encoding(raw, pattern), text, limit)


def decode_ids(ids: np.ndarray, raw: bytes) -> bytes:
    """The bytes of the ids; an id that the rank file lacks is an IndexError beyond the last rank, and no bytes below it."""
    return _tokens(raw).joined(ids)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), decoded: bool = False) -> DataFrame:
    """The ``keep`` columns and ``ids``, an array of ints; with ``decoded`` also the bytes that the ids decode to, from the same pass.

    The rank file goes to the executors as a broadcast of its bytes.
    """
    shared = docs.sparkSession.sparkContext.broadcast(rank_bytes(path))
    added = [T.StructField("ids", T.ArrayType(T.IntegerType(), False), False), *[T.StructField("decoded", T.BinaryType(), False)] * decoded]
    schema = T.StructType([*(docs.schema[c] for c in keep), *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            rows = [encode_text(t.as_py() or "", shared.value, pattern) for t in batch.column(text)]
            ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
            columns = [*(batch.column(c) for c in keep), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows)))]
            if decoded:
                columns.append(pa.array([decode_ids(ids, shared.value) for ids in rows], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema])

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """All columns of ``encoded`` and ``decoded``, the bytes that its ids stand for; null ids are no ids."""
    shared = encoded.sparkSession.sparkContext.broadcast(rank_bytes(path))
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 250):
                batch = whole.slice(start, 250)
                rows = (x.values.to_numpy(zero_copy_only=False) if x.is_valid else np.zeros(0, np.int32) for x in batch.column(ids))
                out = pa.array([decode_ids(x, shared.value) for x in rows], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns, out], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, schema)
