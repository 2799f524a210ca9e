"""Vector bin packing of tokenized documents into training sequences.

A piece is a vector of tokens, one segment and its loss-bearing tokens; a
sequence has a limit on each.  Full-length pieces are cut off a document first.
The rest waits in a bounded pool, and an open sequence takes the fitting piece
whose vector has the largest dot product with the room that is left, each
measured in shares of the limits.  If none fits whole, the longest is cut to
fill the sequence and its remainder goes back to the pool.  A task's last tokens
go to sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks

CAPACITY = 2048
SEGMENTS = 256
#: Pieces that wait in a task; it starts packing when there are so many.
POOL = 2048
END_ID = 1
#: Bytes from which a text can hold letters beyond the Latin blocks (lead byte of U+0280).
BEYOND_LATIN = 0xCA


class Encoder:
    """Token ids of a byte-level BPE.

    The rank file holds the same vocabulary as the tokenizer file and is several
    times faster; it is used for texts in the Latin blocks, where both split
    words alike.  Other texts go through the tokenizer file itself.
    """

    def __init__(self, tokenizer: str, ranks: str | None, pattern: str | None) -> None:
        from tokenizers import Tokenizer

        self.slow, self.fast = Tokenizer.from_file(tokenizer), None
        if ranks and pattern:
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            special = {"<|endoftext|>": len(table)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens=special)

    def ids(self, text: bytes) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype=np.uint32)
        if self.fast is not None and np.frombuffer(text, dtype=np.uint8).max() < BEYOND_LATIN:
            return self.fast.encode_to_numpy(text.decode(), allowed_special="all")
        return np.array(self.slow.encode(text.decode(), add_special_tokens=False).ids, dtype=np.uint32)


class Packer:
    """Packs pieces in arrival order through a pool of bounded size."""

    def __init__(self, first: int, capacity: int = CAPACITY, segments: int = SEGMENTS, loss: int = CAPACITY, pool: int = POOL) -> None:
        self.caps = np.array([capacity, segments, loss], dtype=np.float64)
        self.capacity, self.next_id, self.pool = capacity, first, pool
        self.size = np.zeros((2 * pool + 2, 3))
        self.held: list = []
        self.out: list[tuple] = []

    def add(self, key, ids: np.ndarray, quiet: int = 0) -> None:
        """A document's ids; the first ``quiet`` of them bear no loss."""
        start, n = 0, len(ids)
        while n - start >= self.capacity and self.loss(start, start + self.capacity, quiet) <= self.caps[2]:
            self.place([(key, ids, start, start + self.capacity)])
            start += self.capacity
        if start < n:
            self.hold(key, ids, start, quiet)
        while len(self.held) >= self.pool:
            self.fill()

    @staticmethod
    def loss(start: int, end: int, quiet: int) -> int:
        return max(0, end - max(start, quiet))

    def hold(self, key, ids: np.ndarray, start: int, quiet: int) -> None:
        self.size[len(self.held)] = len(ids) - start, 1, self.loss(start, len(ids), quiet)
        self.held.append((key, ids, start, quiet))

    def take(self, i: int) -> tuple:
        """Remove a waiting piece; the last one moves to its place."""
        piece, last = self.held[i], len(self.held) - 1
        self.held[i], self.size[i] = self.held[last], self.size[last]
        self.held.pop()
        return piece

    def fill(self) -> list[tuple]:
        """One sequence from the pool."""
        room, chosen = self.caps.copy(), []
        while self.held and (room >= 1).all():
            sizes = self.size[: len(self.held)]
            fits = (sizes <= room).all(axis=1)
            if fits.any():
                gain = (sizes / self.caps) @ (room / self.caps)
                key, ids, start, quiet = self.take(int(np.argmax(np.where(fits, gain, -1.0))))
                end = len(ids)
            else:
                key, ids, start, quiet = self.take(int(np.argmax(sizes[:, 0])))
                end = start + int(room[0])
                while self.loss(start, end, quiet) > room[2]:
                    end -= self.loss(start, end, quiet) - int(room[2])
                end = min(max(end, start + 1), len(ids))
            chosen.append((key, ids, start, end))
            room -= (end - start, 1, self.loss(start, end, quiet))
            if end < len(ids):
                self.hold(key, ids, end, quiet)
        self.place(chosen)
        return chosen

    def place(self, pieces: list[tuple]) -> None:
        offset = 0
        for key, ids, start, end in pieces:
            self.out.append((key, start, end - start, zlib.crc32(ids[start:end].astype("<u4").tobytes()), len(ids), self.next_id, offset))
            offset += end - start
        self.next_id += 1

    def finish(self) -> None:
        """Empty the pool; the last sequence is cut into lengths that are powers of two."""
        while self.held:
            before = len(self.out)
            pieces = self.fill()
            total = sum(e - s for _, _, s, e in pieces)
            if self.held or total == self.capacity:
                continue
            del self.out[before:]
            self.next_id -= 1
            while total:
                want = 1 << (total.bit_length() - 1)
                total -= want
                part: list[tuple] = []
                while want:
                    key, ids, start, end = pieces.pop(0)
                    cut = min(end, start + want)
                    part.append((key, ids, start, cut))
                    want -= cut - start
                    if cut < end:
                        pieces.insert(0, (key, ids, cut, end))
                self.place(part)


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, pattern: str | None = None, capacity: int = CAPACITY,
         segments: int = SEGMENTS, loss: int = CAPACITY, quiet: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents with their place in a sequence.

    A document is the ids of its whole text and ``end_id``; a null or empty text
    is ``end_id`` alone.  ``quiet`` names a column with the number of leading ids
    that bear no loss (a prompt; null: none).  Returns doc_id, start, length,
    ids_crc32, doc_tokens, sequence_id and offset; every id lies in one piece.
    Repeated rows are packed each for itself, null ids stay null, other columns
    are ignored, an empty table gives no rows.  There is no shuffle: a task packs
    its own rows in a pool of bounded size, and sequence ids start at the task's
    partition number, so a task that runs again gives the same rows.
    """
    cols = ["doc_id", F.col("text").cast("binary").alias("__text")]
    cols.append((F.coalesce(F.col(quiet), F.lit(0)) if quiet else F.lit(0)).cast("long").alias("__quiet"))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def rows(packer: Packer) -> pa.RecordBatch:
        got, packer.out = packer.out, []
        data = list(zip(*got)) if got else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in data], names)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        packer = Packer(TaskContext.get().partitionId() << 36, capacity, segments, loss)
        for piece, texts in blocks(batches, "__text"):
            encoder = encoder or Encoder(tokenizer, ranks, pattern)
            for key, text, first in zip(piece.column("doc_id").to_pylist(), texts, piece.column("__quiet").to_pylist()):
                packer.add(key, np.append(encoder.ids(text), np.uint32(end_id)), first)
            yield rows(packer)
        packer.finish()
        yield rows(packer)

    return docs.select(*cols).mapInArrow(packed, ", ".join(f"`{n}` long" for n in names))
