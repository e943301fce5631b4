"""Harmonic packing of token sequences, independently in every task.

Class k holds pieces of lengths in (capacity / (k + 1), capacity / k] and its bins get
exactly k pieces; the last class, of all shorter pieces, fills its bin to the capacity
and cuts the piece that reaches over it. A document is cut into full sequences and a tail; the tail gives up a
piece of its class's greatest length, capacity // k, which wastes nothing, up to
``CUTS`` times, and what is left goes into its class whole. Each task fills its own
bins while it reads; it holds less than k pieces of each class. What is still open at
its end is cut at the capacity and then at powers of two, which need no padding.

Nothing is shuffled. A sequence's id holds the task's partition and a count within it,
so a lost task, run again over the same files, gives the same rows.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rareflow.llm.common import whole

CAPACITY = 1024
CLASSES = 32
CUTS = 2
#: A sequence's id is its partition times this, plus its number in the partition.
IDS_PER_TASK = 2**31
SCHEMA = (
    "doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


def pieces_of(length: int, capacity: int = CAPACITY, classes: int = CLASSES, cuts: int = CUTS) -> list[tuple[int, int]]:
    """(length, class) of each piece that a document is cut into, in order."""
    out = [(capacity, 1)] * (length // capacity)
    rest = length % capacity
    for _ in range(cuts):
        k = capacity // rest if rest else classes
        if k >= classes:
            break
        out.append((capacity // k, k) if capacity // k <= rest else (capacity // (k + 1), k + 1))
        rest -= out[-1][0]
    if rest:
        out.append((rest, min(capacity // rest, classes)))
    return out


class Bins:
    """The open bins of one task; ``put`` returns the rows of a bin that is full."""

    def __init__(self, first_id: int, capacity: int = CAPACITY, classes: int = CLASSES):
        self.next_id, self.capacity, self.classes = first_id, capacity, classes
        self.open: dict[int, list[tuple]] = {}
        self.short = 0

    def put(self, k: int, piece: tuple) -> list[tuple]:
        if k >= self.classes:
            return self.put_short(piece)
        bin_ = self.open.setdefault(k, [])
        bin_.append(piece)
        if len(bin_) < k:
            return []
        del self.open[k]
        return self.close(bin_)

    def put_short(self, piece: tuple) -> list[tuple]:
        """A piece of the last class, whose bin is full at the capacity and not at a count."""
        doc, start, ids, total = piece
        room = self.capacity - self.short
        bin_ = self.open.setdefault(self.classes, [])
        bin_.append((doc, start, ids[:room], total))
        if len(ids) < room:
            self.short += len(ids)
            return []
        del self.open[self.classes]
        self.short, rows = 0, self.close(bin_)
        if len(ids) > room:
            rows += self.put_short((doc, start + room, ids[room:], total))
        return rows

    def close(self, pieces: list[tuple]) -> list[tuple]:
        rows, offset = [], 0
        for doc, start, ids, total in pieces:
            rows.append((doc, start, len(ids), _crc32(ids), total, self.next_id, offset))
            offset += len(ids)
        self.next_id += 1
        return rows

    def rest(self) -> list[tuple]:
        """All open pieces as one row of ids, cut at the capacity, then at powers of two."""
        rows, now, room = [], [], 0
        left = sum(len(p[2]) for bin_ in self.open.values() for p in bin_)
        for k in sorted(self.open):
            for doc, start, ids, total in self.open[k]:
                while len(ids):
                    if not room:
                        room = min(self.capacity, 1 << (left.bit_length() - 1))
                        left -= room
                    part = ids[:room]
                    now.append((doc, start, part, total))
                    start, ids, room = start + len(part), ids[room:], room - len(part)
                    if not room:
                        rows += self.close(now)
                        now = []
        self.open, self.short = {}, 0
        return rows


def _crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


class Encoder:
    """Token ids as ``tokenizers`` gives them for the vocabulary in ``path``.

    The same vocabulary as a rank file, if there is one beside it, encodes about three
    times as fast by ``tiktoken``. It is used only if every token of the vocabulary has
    the same bytes and id in both and the merges stand in the order of the ranks; and of
    the texts, a hashed one in ``COMPARED`` is encoded by both, and the task fails should
    they ever differ. Texts that hold the string of a special token, and texts that the
    rank file cannot take, go to ``tokenizers``.
    """

    COMPARED = 64

    def __init__(self, path: str, ranks: str | None = None):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.slow = Tokenizer.from_file(path)
        self.special = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        self.fast = self._ranks(path, ranks) if ranks and os.path.exists(ranks) else None

    def _ranks(self, path: str, ranks: str):
        import base64

        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
        if not same_vocabulary(path, table):
            return None
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str) -> list[int]:
        data = text.encode("utf-8", "replace")
        text = data.decode("utf-8")
        if self.fast is None or any(s in text for s in self.special):
            return self.slow.encode(text, add_special_tokens=False).ids
        got = self.fast.encode_ordinary(text)
        if zlib.crc32(data) % self.COMPARED == 0 and got != self.slow.encode(text, add_special_tokens=False).ids:
            raise ValueError("the rank file encodes a text otherwise than the vocabulary; pack without it")
        return got


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary, and the byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def same_vocabulary(path: str, ranks: dict[bytes, int]) -> bool:
    """Whether the vocabulary file has just the rank file's tokens, and merges by ascending rank."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    byte = byte_letters()

    def spelled(token: str) -> bytes:
        return bytes(byte[c] for c in token)

    try:
        same = {spelled(t): i for t, i in model["vocab"].items()} == ranks
        made = [ranks[spelled("".join(m) if isinstance(m, list) else m.replace(" ", ""))] for m in model["merges"]]
    except KeyError:
        return False
    return same and all(a < b for a, b in zip(made, made[1:]))


def pack(
    docs: DataFrame,
    vocabulary: str,
    ranks: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = 0,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text is the end id alone. Rows with the same id are packed each for
    itself; a null id stays null. An empty table gives no rows. Long texts are encoded
    whole. ``vocabulary`` and ``ranks`` are files that every executor has.
    """
    narrow = docs.select(F.col(id_col).alias("doc_id"), whole(docs[text_col]).alias("text"))
    schema = SCHEMA.format(id_type=docs.schema[id_col].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, ranks)
        bins = Bins(TaskContext.get().partitionId() * IDS_PER_TASK, capacity)
        kind = pa.null()
        for batch in batches:
            rows, kind = [], batch.schema.field(0).type
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.array([*encoder.ids(text), end_id], dtype=np.uint32)
                at = 0
                for length, k in pieces_of(len(ids), capacity):
                    rows += bins.put(k, (doc, at, ids[at : at + length].copy(), len(ids)))
                    at += length
            if rows:
                yield _batch(rows, kind)
        if rows := bins.rest():
            yield _batch(rows, kind)

    return narrow.mapInArrow(run, schema)


def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    docs, *numbers = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(docs, kind), *(pa.array(n, pa.int64()) for n in numbers)], names)
