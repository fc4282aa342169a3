"""Byte-level BPE: encoding and decoding by a rank file, in linear time."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import bounded_batches

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
NONE = -1


class Cache(dict):
    """A dict that asks ``make`` for what it lacks and keeps it, unless the key is long; emptied when full."""

    def __init__(self, make, most: int = 400_000, longest: int = 48):
        super().__init__()
        self.make, self.most, self.longest = make, most, longest

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


class ByteBpe:
    """The tokenizer of a rank file: merges by rank, inside the matches of ``pattern``.

    A sequence of tokens is what the merges give if and only if each two neighbours are. So the longest token at each
    place is tried first, then shorter ones; a place from which nothing fits is marked and never entered again, which
    makes the time linear in the text.
    """

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.rank = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.token = [b""] * (max(self.rank.values()) + 1)
        self.matcher = ahocorasick.Automaton()
        for token, rank in self.rank.items():
            self.token[rank] = token
            # One character per byte, since the matcher works on characters.
            self.matcher.add_word(token.decode("latin-1"), rank)
        self.matcher.make_automaton()
        self.size = [len(token) for token in self.token]
        self.pattern = regex.compile(pattern)
        self.parts: dict[int, tuple[int, int]] = {}
        self.prefix: dict[int, int] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.pieces = Cache(lambda piece: self.encode_piece(piece.encode()).tobytes())

    def halves(self, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a single byte."""
        if self.size[rank] == 1:
            return None
        if rank not in self.parts:
            token = self.token[rank]
            parts = [token[i : i + 1] for i in range(len(token))]
            while len(parts) > 2:
                merges = [self.rank.get(a + b, rank) for a, b in zip(parts, parts[1:])]
                at = min(range(len(merges)), key=merges.__getitem__)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self.parts[rank] = self.rank[parts[0]], self.rank[parts[1]]
        return self.parts[rank]

    def shorter(self, rank: int) -> int:
        """The longest token that is a proper prefix of this one."""
        if rank not in self.prefix:
            token = self.token[rank]
            self.prefix[rank] = next((r for n in range(len(token) - 1, 0, -1) if (r := self.rank.get(token[:n])) is not None), NONE)
        return self.prefix[rank]

    def neighbours(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both leaves just these two tokens."""
        key = left, right
        if key not in self.fits:
            if len(self.fits) >= 2_000_000:
                self.fits.clear()
            self.fits[key] = self._neighbours(left, right)
        return self.fits[key]

    def _neighbours(self, left: int, right: int) -> bool:
        # Undo the merges along the seam, the latest first. While two tokens meet at the seam, their own merge must
        # not come before those that swallow them; of equal merges the left one comes first.
        left_until = right_until = float("inf")
        while True:
            merge = self.rank.get(self.token[left] + self.token[right])
            if merge is not None and merge < left_until and merge <= right_until:
                return False
            parts_left, parts_right = self.halves(left), self.halves(right)
            if parts_left and (left > right or not parts_right):
                left_until, left = left, parts_left[1]
            elif parts_right:
                right_until, right = right, parts_right[0]
            else:
                return True

    def encode_piece(self, piece: bytes) -> np.ndarray:
        n = len(piece)
        longest = np.full(n, NONE, np.int64).tolist()
        for end, rank in self.matcher.iter(piece.decode("latin-1")):
            longest[end + 1 - self.size[rank]] = rank  # ends only grow, so the last match of a start is the longest
        dead = bytearray(n + 1)
        tokens: list[int] = []
        at, rank = 0, longest[0] if n else NONE
        while at < n:
            while rank != NONE and (
                dead[at + self.size[rank]] or (tokens and not self.neighbours(tokens[-1], rank))
            ):
                rank = self.shorter(rank)
            if rank == NONE:
                dead[at] = 1
                last = tokens.pop()
                at -= self.size[last]
                rank = self.shorter(last)
            else:
                tokens.append(rank)
                at += self.size[rank]
                rank = longest[at] if at < n else NONE
        return np.array(tokens, "<u4")

    def encode(self, text: str, at_once: int = 200_000) -> Iterator[bytes]:
        """The ids as little-endian bytes, in runs of so many pieces."""
        if len(text) <= at_once:
            yield b"".join(map(self.pieces.__getitem__, self.pattern.findall(text)))
            return
        found = self.pattern.finditer(text)
        while run := [self.pieces[m[0]] for m in islice(found, at_once)]:
            yield b"".join(run)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def digests(bpe: ByteBpe, texts: Iterable[str | None]) -> Iterator[tuple[int, str, str]]:
    """(tokens, hash of the ids, hash of the decoded ids) of each text."""
    for text in texts:
        count, ids, plain = 0, hashlib.sha256(), hashlib.sha256()
        for run in bpe.encode(text or ""):
            count += len(run) // 4
            ids.update(run)
            plain.update(bpe.decode(run))
        yield count, ids.hexdigest(), plain.hexdigest()


def _columns(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    bounded_batches(docs.sparkSession)
    return docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))


def encode(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every row. NULL and empty texts have no ids; rows are encoded one by one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(path, pattern)
        for batch in batches:
            ids = [np.frombuffer(b"".join(bpe.encode(t or "")), "<i4") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return _columns(docs, doc_id, text).mapInArrow(work, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, text binary) from (doc_id, ids). NULL ids give no bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(path, pattern)
        for batch in batches:
            plain = [bpe.decode(np.array(ids or [], "<u4").tobytes()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(plain, pa.binary())], ["doc_id", "text"])

    bounded_batches(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(work, "doc_id long, text binary")


def round_trip(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode every row and keep digests only, so that ids of long texts are never held whole.

    NULL and empty texts have no tokens, both digests are those of no bytes. ``doc_id`` is passed on, NULL as well.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(path, pattern)
        for batch in batches:
            counts, ids, plain = list(zip(*digests(bpe, batch.column(1).to_pylist()))) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(plain, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return _columns(docs, doc_id, text).mapInArrow(work, SCHEMA)
