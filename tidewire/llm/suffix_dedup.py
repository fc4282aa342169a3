"""Repeated passages: suffixes in order by a distributed merge sort that knows common prefixes.

A passage of ``length`` bytes that occurs twice holds, at the same place in both, the k-gram with the least hash of
all its k-grams. So it is enough to sort the suffixes that start at such anchors, about one in 120 bytes, and of these
only those whose k-gram occurs again.

1. Texts are read once, in blocks. Hashes of the anchors' k-grams go to parts of the hash space and are counted there;
   a document learns which of its anchors have a counterpart. Equal texts count once.
2. The texts with such anchors are cut into sorted runs of suffixes, front-coded (the length shared with the suffix
   before, then the rest), each with the bytes before the anchor. Runs are cut at splitters and exchanged.
3. In each range a loser tree merges the runs. It carries common prefixes along and compares only what lies beyond.
4. For each distance from passage start to anchor, two anchors have the same passage if the suffixes share enough
   bytes to the right and the bytes before share enough to the left: both are classes in a sorted order.
5. Each anchor's first and last such passage go back to its documents, which are cut.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import bounded_batches, free_name, hashed_below, numbered, row_uid
from .parts import HASH_BITS, blocks, cut_parts, lean, mix, pack, pack_ids, unpack, unpack_ids

#: Anchors that a part of the hash space has on average, and suffixes that a merged range has on average.
PART_ANCHORS, RANGE_SUFFIXES = 1_000_000, 30_000
#: Bytes of text in a block, bytes of an Arrow batch, and rows that are sent at once.
BLOCK, ARROW_BYTES, SENT_ROWS = 3_000_000, 8_000_000, 32
#: Splitters are chosen among so many sampled suffixes per range, by their first bytes.
SAMPLED, SPLITTER_BYTES = 32, 32
#: Words are found again by codes of so many bytes each; of so many words a task remembers the codes.
CODE_BYTES, KNOWN_WORDS = 6, 1 << 17
WORD = re.compile(rb"[^\t-\r ]+")
#: Positions that are worked on at once: some hundred bytes of arrays each.
SLICE = 1 << 17
SENT = "part long, block long, entries binary, tags binary, uids binary, ids binary, sizes binary, hashes binary"
SCANNED = "uid long, doc_id long, n_bytes long, sha binary, anchors binary"
RUN = "part long, block long, shared binary, lengths binary, tails binary, before binary, befores binary, many binary, owners binary"


class Anchors:
    """Finds the k-grams with the least hash in each window of ``length`` bytes."""

    def __init__(self, length: int):
        self.length, self.k = length, max(1, 2 * length // 5)
        self.starts = length - self.k + 1
        most = SLICE + length
        base = np.uint64(0x9E3779B97F4A7C15)
        inverse = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
        self.powers = np.cumprod(np.r_[np.uint64(1), np.full(most, base)], dtype=np.uint64)
        self.inverses = np.cumprod(np.r_[np.uint64(1), np.full(most, inverse)], dtype=np.uint64)
        self.letters = mix(np.arange(1, 257, dtype=np.uint64) * base)

    def hashes(self, piece: np.ndarray) -> np.ndarray:
        """A hash of each k-gram: the same wherever it stands."""
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(self.letters[piece] * self.powers[: len(piece)], out=sums[1:])
        count = len(piece) - self.k + 1
        return mix((sums[self.k :] - sums[:count]) * self.inverses[:count])

    def least(self, values: np.ndarray) -> np.ndarray:
        """The least value of each ``starts`` neighbours."""
        w, n = self.starts, len(values)
        rows = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
        rows[:n] = values
        rows = rows.reshape(-1, w)
        forward = np.minimum.accumulate(rows, axis=1).ravel()
        backward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        return np.minimum(backward[: n - w + 1], forward[w - 1 : n])

    def find(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of the text, place in it, hash) of every anchor, in order."""
        lengths = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(lengths)
        long = lengths >= self.length
        steps = np.zeros(int(lengths.sum()) + 1, np.int8)
        np.add.at(steps, (ends - lengths)[long], 1)
        np.add.at(steps, (ends - self.length + 1)[long], -1)
        inside = np.cumsum(steps, dtype=np.int8)[:-1] > 0
        buffer = np.frombuffer(b"".join(texts), np.uint8)
        places, hashes = [np.array([], np.int64)], [np.array([], np.uint64)]
        for low in range(0, len(buffer) - self.length + 1, SLICE):
            own = self.hashes(buffer[low : low + SLICE + self.length - 1])
            # The place in the low half makes the first of equal hashes the least.
            marked = own & np.uint64(0xFFFFFFFF00000000) | np.arange(len(own), dtype=np.uint64)
            least = self.least(marked)
            least = least[inside[low : low + len(least)]]
            at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
            at = at[np.r_[True, np.diff(at) != 0]] if len(at) else at
            places.append(at + low)
            hashes.append(own[at])
        place, first = np.unique(np.concatenate(places), return_index=True)
        text = np.searchsorted(ends, place, side="right")
        # What is least somewhere is small everywhere: mixed again, else nearly all would go to the first parts of the hash space.
        return text, place - (ends - lengths)[text], mix(np.concatenate(hashes)[first])


#: Makes, in a task, the function that turns a text's bytes into those that are searched.
Recode = Callable[[], Callable[[bytes], bytes]]


def word_coder() -> Callable[[bytes], bytes]:
    """Gives each word of a text a code of its own, and leaves out the blanks."""
    code = lru_cache(KNOWN_WORDS)(lambda word: hashlib.blake2b(word, digest_size=CODE_BYTES).digest())
    return lambda raw: b"".join(map(code, raw.split()))


def _send(rows: DataFrame, length: int, parts: int, recode: Recode | None = None) -> DataFrame:
    """A header row per block, then a row for each block and part of the hash space. A block is known by its first uid."""
    names = [c.split()[0] for c in SENT.split(", ")]
    types = [pa.int64()] * 2 + [pa.binary()] * 6

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, searched = Anchors(length), recode() if recode else None
        for held in blocks(batches, "raw", BLOCK):
            block, texts = held["uid"][0], held["raw"]
            if searched:
                texts = [searched(raw) for raw in texts]
            digests = [hashlib.sha256(raw).digest() for raw in texts]
            header = (
                np.array(held["uid"], "<i8").tobytes(),
                pack_ids(held["doc_id"]),
                np.array([len(raw) for raw in texts], "<i8").tobytes(),
                b"".join(digests),
            )
            out = [(-1 - block, block, None, None, *header)]
            owner, place, hashes = anchors.find(texts)
            # Equal for the same place of equal texts, which are no repetition for one another here.
            tags = mix(np.frombuffer(b"".join(d[:8] for d in digests), "<u8")[owner] ^ mix(place.astype(np.uint64) + np.uint64(1)))
            keys = hashes >> np.uint64(64 - HASH_BITS) << np.uint64(16) | owner.astype(np.uint64)
            order = np.argsort(keys, kind="stable")
            keys, tags = keys[order], tags[order]
            for part, low, high in cut_parts(keys, parts):
                out.append((part, block, pack(keys[low:high]), tags[low:high].astype("<u8").tobytes(), *[None] * 4))
                if len(out) == SENT_ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    bounded_batches(rows.sparkSession, ARROW_BYTES)
    return rows.select("uid", "doc_id", "raw").mapInArrow(work, SENT)


def _repeated(part: pa.Table) -> pa.Table:
    """Says to each block which of its anchors occur again, in another text or elsewhere in the same."""
    names = [c.split()[0] for c in SENT.split(", ")]
    if part.column("part")[0].as_py() < 0:
        return part.select(names)
    cells = [part.column(c).to_pylist() for c in ("block", "entries", "tags")]
    keys = [unpack(entries) for entries in cells[1]]
    hashes = np.concatenate(keys) >> np.uint64(16)
    tags = np.frombuffer(b"".join(cells[2]), "<u8")
    order = np.lexsort((tags, hashes))
    new_hash = np.r_[True, np.diff(hashes[order]) != 0]
    new_pair = new_hash | np.r_[True, np.diff(tags[order]) != 0]
    group = np.cumsum(new_hash) - 1
    again = np.zeros(len(hashes), bool)
    again[order] = np.bincount(group, weights=new_pair)[group] > 1
    out, low = [], 0
    for block, own in zip(cells[0], keys):
        here = again[low : low + len(own)]
        low += len(own)
        if here.any():
            out.append((0, block, own[here].astype("<u8").tobytes(), *[None] * 5))
    types = [pa.int64()] * 2 + [pa.binary()] * 6
    return pa.table([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 8, types)], names)


def _per_document(rows: pa.Table) -> pa.Table:
    cells = {c: rows.column(c).to_pylist() for c in ("entries", "uids", "ids", "sizes", "hashes")}
    header = next(i for i, h in enumerate(cells["uids"]) if h is not None)
    uids, sizes = (np.frombuffer(cells[c][header], "<i8") for c in ("uids", "sizes"))
    shas = cells["hashes"][header]
    keys = np.frombuffer(b"".join(e for e in cells["entries"] if e), "<u8")
    owner = (keys & np.uint64(0xFFFF)).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    keys, cuts = keys[order] >> np.uint64(16), np.searchsorted(owner[order], np.arange(len(uids) + 1)).tolist()
    found = [np.unique(keys[a:b]).astype("<u8").tobytes() if a < b else None for a, b in zip(cuts[:-1], cuts[1:])]
    columns = [
        pa.array(uids), unpack_ids(cells["ids"][header]), pa.array(sizes),
        pa.array([shas[32 * i : 32 * i + 32] for i in range(len(uids))], pa.binary()), pa.array(found, pa.binary()),
    ]
    return pa.table(columns, [c.split()[0] for c in SCANNED.split(", ")])


def scan(rows: DataFrame, length: int, recode: Recode | None = None) -> DataFrame:
    """A row per document with its digest and the hashes of its anchors that occur again; NULL if it has none."""
    total = rows.agg(F.sum(F.octet_length("raw"))).first()[0] or 0
    anchors = 2 * total // (length - 2 * length // 5 + 2)
    sent = _send(rows, length, max(64, anchors // PART_ANCHORS), recode)
    counted = sent.groupBy("part").applyInArrow(lean(_repeated), SENT)
    return counted.groupBy("block").applyInArrow(lean(_per_document), SCANNED)


def _chosen(anchors: Anchors, texts: list[bytes], wanted: list[bytes]) -> tuple[list[int], list[int]]:
    """(number of the text, place) of the anchors whose hash a text asks for."""
    owner, place, hashes = anchors.find(texts)
    high = hashes >> np.uint64(64 - HASH_BITS)
    take = np.zeros(len(owner), bool)
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    for text, (low, end) in enumerate(zip(cuts[:-1], cuts[1:])):
        if low < end:
            take[low:end] = np.isin(high[low:end], np.frombuffer(wanted[text], "<u8"))
    return owner[take].tolist(), place[take].tolist()


def _common(rows: list[bytes], width: int) -> np.ndarray:
    """The length of the common prefix of each row with the row before, 0 for the first."""
    shared = np.zeros(len(rows), np.int64)
    for low in range(0, len(rows) - 1, 10_000):
        some = rows[low : low + 10_001]
        sizes = np.array([len(r) for r in some])
        grid = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in some), np.uint8).reshape(len(some), width)
        differ = grid[1:] != grid[:-1]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        shared[low + 1 : low + len(some)] = np.minimum(first, np.minimum(sizes[1:], sizes[:-1]))
    return shared


def _runs(texts: DataFrame, length: int, splitters: list[bytes]) -> DataFrame:
    """Sorted front-coded runs of a block's suffixes, cut at the splitters. Equal surroundings are one entry."""
    names = [c.split()[0] for c in RUN.split(", ")]
    types = [pa.int64()] * 2 + [pa.binary()] * 7

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(length)
        reach = anchors.starts - 1
        for held in blocks(batches, "raw"):
            raws, uids = held["raw"], held["uid"]
            entries: dict[tuple[bytes, bytes], list[tuple[int, int]]] = {}
            for text, at in zip(*_chosen(anchors, raws, held["anchors"])):
                raw = raws[text]
                key = raw[at : at + length], raw[max(0, at - reach) : at]
                entries.setdefault(key, []).append((uids[text], at))
            ordered = sorted(entries)
            # Suffixes that share a k-gram must not be parted.
            width = min(SPLITTER_BYTES, anchors.k)
            ranges = [bisect_right(splitters, suffix[:width]) for suffix, _ in ordered]
            cuts = np.searchsorted(ranges, np.arange(len(splitters) + 2)).tolist()
            for part, (low, high) in enumerate(zip(cuts[:-1], cuts[1:])):
                if low == high:
                    continue
                some = ordered[low:high]
                shared = _common([s for s, _ in some], length)
                owners = [entries[e] for e in some]
                row = (
                    part, uids[0], shared.astype("<u4").tobytes(),
                    np.array([len(s) for s, _ in some], "<u4").tobytes(),
                    b"".join(s[n:] for (s, _), n in zip(some, shared.tolist())),
                    np.array([len(b) for _, b in some], "<u4").tobytes(),
                    b"".join(b for _, b in some),
                    np.array([len(o) for o in owners], "<u4").tobytes(),
                    np.array([x for o in owners for pair in o for x in pair], "<i8").tobytes(),
                )
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)

    bounded_batches(texts.sparkSession)
    return texts.select("uid", "raw", "anchors").mapInArrow(work, RUN)


def splitters_of(texts: DataFrame, length: int, ranges: int) -> list[bytes]:
    """Prefixes that cut the suffixes into about equal ranges: a sample whose size goes with the number of ranges."""
    if ranges < 2:
        return []

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(length)
        for batch in batches:
            raws, wanted = (batch.column(c).to_pylist() for c in ("raw", "anchors"))
            owner, place = _chosen(anchors, raws, wanted)
            taken = [raws[o][p : p + min(SPLITTER_BYTES, anchors.k)] for o, p in zip(owner, place)]
            # Of a document, four at most, spread over it.
            rank = np.arange(len(owner)) - np.searchsorted(owner, owner) if owner else np.array([])
            count = np.bincount(owner)[owner] if owner else np.array([])
            some = [t for t, r, n in zip(taken, rank, count) if r % max(1, -(-n // 4)) == 0]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary())], ["prefix"])

    # Some times as many as are wanted go by a bound of their hash: each task would else send as many whole texts.
    wanted = ranges * SAMPLED // 4
    near = texts.select("raw", "anchors", F.xxhash64("uid").alias("h")).where(hashed_below("h", 4 * wanted / max(1, texts.count())))
    few = near.orderBy("h").limit(wanted)
    found = sorted(r.prefix for r in few.select("raw", "anchors").mapInArrow(work, "prefix binary").collect())
    return sorted({bytes(found[len(found) * i // ranges]) for i in range(1, ranges)}) if found else []


class Run:
    """A front-coded run, read from its start."""

    def __init__(self, shared: bytes, lengths: bytes, tails: bytes):
        self.shared, self.lengths = np.frombuffer(shared, "<u4").tolist(), np.frombuffer(lengths, "<u4").tolist()
        self.tails, self.at, self.place, self.suffix = tails, 0, -1, b""

    def step(self) -> tuple[bytes, int] | None:
        """The next suffix and how much it shares with the one before."""
        self.place += 1
        if self.place == len(self.lengths):
            return None
        shared = self.shared[self.place]
        end = self.at + self.lengths[self.place] - shared
        self.suffix = self.suffix[:shared] + self.tails[self.at : end]
        self.at = end
        return self.suffix, shared


def _beyond(a: bytes, b: bytes, low: int) -> int:
    """The length of the common prefix of a and b, of which ``low`` is known."""
    high = min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def merge_runs(runs: list[Run]) -> Iterator[tuple[int, int, int]]:
    """(run, place in it, common prefix with the suffix given before) in order of the suffixes, by a loser tree.

    Each contender knows its common prefix with the last winner on its path. The one with the longer prefix is the
    smaller; only if both are equal are bytes compared, those beyond the prefix.
    """
    leaves = 1 << max(0, len(runs) - 1).bit_length()
    now: list[bytes | None] = [None] * leaves
    known = [0] * leaves
    for i, run in enumerate(runs):
        first = run.step()
        now[i] = first[0] if first else None

    def wins(a: int, b: int) -> bool:
        """Whether a comes before b; the loser's prefix is then the one with the winner."""
        if now[a] is None or now[b] is None:
            return now[b] is None
        if known[a] != known[b]:
            return known[a] > known[b]
        x, y = now[a], now[b]
        both = _beyond(x, y, known[a])
        first = x[both : both + 1] < y[both : both + 1] or (len(x) == len(y) == both and a < b)
        known[b if first else a] = both
        return first

    losers = [0] * leaves
    level = list(range(leaves))
    while len(level) > 1:
        following = []
        for i in range(0, len(level), 2):
            a, b = level[i], level[i + 1]
            winner = a if wins(a, b) else b
            losers[(len(level) + i) // 2] = a + b - winner
            following.append(winner)
        level = following
    winner, shared = level[0], 0
    while now[winner] is not None:
        yield winner, runs[winner].place, shared
        following = runs[winner].step()
        now[winner], known[winner] = following if following else (None, 0)
        node = (winner + leaves) // 2
        while node:
            other = losers[node]
            if not wins(winner, other):
                losers[node], winner = winner, other
            node //= 2
        shared = known[winner]


def passages(
    shared: np.ndarray, right: np.ndarray, lefts: list[bytes], many: np.ndarray, length: int, reach: int
) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest distance from a passage's start to the anchor, for passages that occur again; -1: none.

    Entries are in order of their suffixes; ``shared`` are the common prefixes, ``right`` the lengths. ``lefts`` are
    the bytes before the anchor, ``many`` how often an entry occurs.
    """
    n = len(lefts)
    backward = [b[::-1] for b in lefts]
    by_left = np.array(sorted(range(n), key=backward.__getitem__), np.int64)
    shared_left = _common([backward[i] for i in by_left.tolist()], max(1, reach))
    left = np.array([len(b) for b in lefts], np.int64)
    least, most = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    # An entry that occurs more than once has all its passages twice.
    lowest = np.maximum(0, length - right)
    own = (many > 1) & (lowest <= left)
    least[own], most[own] = lowest[own], left[own]
    by_right = np.empty(n, np.int64)
    class_left = np.empty(n, np.int64)
    for d in range(min(reach, int(left.max(initial=0))) + 1):
        by_right = np.cumsum(shared < length - d)
        class_left[by_left] = np.cumsum(shared_left < d) if d else 0
        fit = np.flatnonzero((left >= d) & (right >= length - d))
        keys = by_right[fit] * (n + 1) + class_left[fit]
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        twice = fit[order[np.r_[same, False] | np.r_[False, same]]] if len(fit) else fit
        least[twice] = np.where(least[twice] < 0, d, np.minimum(least[twice], d))
        most[twice] = np.maximum(most[twice], d)
    return least, most


def _merge(length: int, reach: int):
    def work(rows: pa.Table) -> pa.Table:
        cells = {c: rows.column(c).to_pylist() for c in ("block", "shared", "lengths", "tails", "before", "befores", "many")}
        runs = [Run(*x) for x in zip(cells["shared"], cells["lengths"], cells["tails"])]
        sizes = [len(r.lengths) for r in runs]
        first = np.cumsum(sizes) - sizes
        order = np.empty(sum(sizes), np.int64)
        shared = np.empty(sum(sizes), np.int64)
        starts = first.tolist()
        for i, (run, place, common) in enumerate(merge_runs(runs)):
            order[i], shared[i] = starts[run] + place, common
        lefts = []
        for sizes_before, bytes_before in zip(cells["before"], cells["befores"]):
            ends = np.cumsum(np.frombuffer(sizes_before, "<u4"), dtype=np.int64).tolist()
            lefts += [bytes_before[a:b] for a, b in zip([0, *ends], ends)]
        right = np.concatenate([np.frombuffer(x, "<u4") for x in cells["lengths"]]).astype(np.int64)
        many = np.concatenate([np.frombuffer(x, "<u4") for x in cells["many"]])
        # Whole groups that share a k-gram stand together, so they can be taken some at a time.
        low, high = passages(shared, right[order], [lefts[i] for i in order.tolist()], many[order], length, reach)
        least, most = np.empty_like(low), np.empty_like(high)
        least[order], most[order] = low, high
        cuts = np.cumsum(sizes)[:-1]
        part = rows.column("part")[0].as_py()
        return pa.table(
            {
                "part": pa.array([part] * len(runs), pa.int64()),
                "block": pa.array(cells["block"], pa.int64()),
                "least": pa.array([x.astype("<i4").tobytes() for x in np.split(least, cuts)], pa.binary()),
                "most": pa.array([x.astype("<i4").tobytes() for x in np.split(most, cuts)], pa.binary()),
            }
        )

    return work


def union_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans made one."""
    merged: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1] = merged[-1][0], max(end, merged[-1][1])
        else:
            merged.append((start, end))
    return merged


def _spans(merged: DataFrame, length: int) -> DataFrame:
    """(uid, start, end) of the bytes that passages of a run's entries cover, joined in each run."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for many, owners, least, most in zip(*(batch.column(c).to_pylist() for c in ("many", "owners", "least", "most"))):
                counts = np.frombuffer(many, "<u4")
                uid, at = np.frombuffer(owners, "<i8").reshape(-1, 2).T
                low, high = (np.repeat(np.frombuffer(x, "<i4"), counts) for x in (least, most))
                hit = high >= 0
                by_doc: dict[int, list] = {}
                starts, ends = (at - high)[hit].tolist(), (at - low + length)[hit].tolist()
                for doc, start, end in zip(uid[hit].tolist(), starts, ends):
                    by_doc.setdefault(doc, []).append((start, end))
                out += [(doc, a, b) for doc, spans in by_doc.items() for a, b in union_spans(spans)]
            columns = list(zip(*out)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["uid", "start", "end"])

    return merged.select("many", "owners", "least", "most").mapInArrow(work, "uid long, start long, end long")


class Found:
    """What is known of a table's repeated passages: ``marked`` rows, the ``texts`` that were searched, ``spans``."""

    def __init__(self, marked: DataFrame, texts: DataFrame, spans: DataFrame):
        self.marked, self.texts, self.spans = marked, texts, spans


def find_repeated(docs: DataFrame, length: int = 400, doc_id: str = "doc_id", text: str = "text") -> Found:
    """Finds every byte that is covered by a string of ``length`` bytes which also starts anywhere else.

    ``marked``: uid, doc_id, n_bytes, sha, ``whole`` (an equal text exists and it is long enough, so all of it goes).
    ``spans``: uid and the sorted array of (start, end) for all other documents with repeated bytes.
    """
    return _find(numbered(docs, doc_id, text), length)


def find_repeated_words(docs: DataFrame, words: int, doc_id: str = "doc_id", text: str = "text") -> Found:
    """Finds every word of a sequence of ``words`` words which also starts at any other word, whatever the blanks.

    Each word becomes a code of its own, so ``n_bytes`` and ``spans`` count bytes of codes; see :func:`_word_spans`.
    A string of ``words`` codes that starts inside a code repeats only if two parts of different codes agree by chance,
    ``CODE_BYTES`` bytes in all, or if the whole codes around it repeat as well.
    """

    return _find(numbered(docs, doc_id, text), words * CODE_BYTES, word_coder)


def _recoded(rows: DataFrame, recode: Recode) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searched = recode()
        for batch in batches:
            codes = [searched(raw) for raw in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.binary()), batch.column(2)], ["uid", "raw", "anchors"])

    bounded_batches(rows.sparkSession, ARROW_BYTES)
    return rows.select("uid", "raw", "anchors").mapInArrow(work, "uid long, raw binary, anchors binary")


def _find(rows: DataFrame, length: int, recode: Recode | None = None) -> Found:
    scanned = materialize(scan(rows, length, recode), "scanned")
    # Stored before the join: else the join would use the grouping's partitions, in which Spark cannot split a hot text.
    equal = materialize(scanned.groupBy("sha").agg(F.count("*").alias("n"), F.min("uid").alias("first")), "equal")
    known = scanned.join(equal, "sha")
    whole = (F.col("n") > 1) & (F.col("n_bytes") >= length)
    marked = materialize(known.select("uid", "doc_id", "n_bytes", "sha", whole.alias("whole"),
                                      F.when(F.col("uid") == F.col("first"), F.col("anchors")).alias("anchors")), "marked")
    # One of several equal texts stands for all; texts without a repeated anchor are not looked at again.
    asked = marked.where("anchors IS NOT NULL").select("uid", "anchors")
    joined = rows.select("uid", "raw").join(asked, "uid")
    texts = materialize(_recoded(joined, recode) if recode else joined, "texts")
    suffixes = texts.agg(F.sum(F.octet_length("anchors"))).first()[0] or 0
    ranges = -(-suffixes // (8 * RANGE_SUFFIXES)) or 1
    runs = materialize(_runs(texts, length, splitters_of(texts, length, ranges)), "runs")
    reach = length - max(1, 2 * length // 5)
    merged = runs.drop("owners").groupBy("part").applyInArrow(
        lean(_merge(length, reach)), "part long, block long, least binary, most binary"
    )
    covered = _spans(runs.select("part", "block", "many", "owners").join(merged, ["part", "block"]), length)
    spans = covered.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    return Found(marked.drop("anchors"), texts.drop("anchors"), materialize(spans, "spans"))


def _cut(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    ends = [0, *(end for _, end in spans)]
    starts = [*(start for start, _ in spans), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(ends, starts))


def _word_spans(raw: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The bytes of the words whose codes lie in the spans, each with the blanks up to the next word."""
    starts = [*(word.start() for word in WORD.finditer(raw)), len(raw)]
    starts[0] = 0
    whole = [(-(-start // CODE_BYTES), end // CODE_BYTES) for start, end in union_spans(spans)]
    return [(starts[low], starts[high]) for low, high in whole if low < high]


def _holes(found: Found, unit: str) -> DataFrame:
    """(uid, bytes, codes): the spans of all documents with repetitions in the column of their unit, the other NULL."""
    all_of = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    spans = found.marked.where("whole").select("uid", all_of.alias("spans")).unionByName(found.spans)
    none = F.lit(None).cast(spans.schema["spans"].dataType)
    return spans.select("uid", *((F.col("spans") if unit == u else none).alias(u) for u in ("bytes", "codes")))


def _holes_of(founds: list[tuple[Found, str]]) -> DataFrame:
    """(uid, spans): one row per document with repetitions. A whole document may also have spans; texts are cut by their union."""
    spans = reduce(DataFrame.unionByName, [_holes(found, unit) for found, unit in founds])
    both = F.struct(*(F.flatten(F.collect_list(u)).alias(u) for u in ("bytes", "codes")))
    return spans.groupBy("uid").agg(both.alias("spans"))


def _cut_texts(rows: DataFrame, uid: str, spans: DataFrame, text: str) -> DataFrame:
    """``rows`` without ``uid``, the spans of their row cut out of ``text``; ``n_chars``, if there is one, counted anew."""
    names, holes = [c for c in rows.columns if c != uid], free_name(rows, "_spans")
    joined = rows.join(spans.select(F.col("uid").alias(uid), F.col("spans").alias(holes)), uid, "left")
    cut = joined.where(F.col(holes).isNotNull()).select(*names, holes)
    at, chars = names.index(text), names.index("n_chars") if "n_chars" in names else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for value, spans in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist()):
                raw = (value or "").encode()
                bytes_, codes = ([(s["start"], s["end"]) for s in spans[u]] for u in ("bytes", "codes"))
                union = union_spans(bytes_ + _word_spans(raw, codes))
                kept.append(_cut(raw, union).decode("utf-8", "ignore"))
            columns = list(batch.columns[: len(names)])
            columns[at] = pa.array(kept, columns[at].type)
            if chars is not None:
                columns[chars] = pa.array([len(k) for k in kept]).cast(columns[chars].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    bounded_batches(rows.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*names).schema)
    return joined.where(F.col(holes).isNull()).select(*names).unionByName(cut.mapInArrow(work, schema))


def remove_repeated(
    docs: DataFrame, length: int = 400, doc_id: str = "doc_id", text: str = "text", words: int | None = None
) -> DataFrame:
    """``docs`` with all their columns, the repeated bytes cut out of ``text``.

    With ``words``, sequences of that many words (split at the six ASCII blanks) that occur again are cut as well,
    however few bytes they have; both rules judge the input. Bytes of a character that is cut in two go as well. A document may be left empty; ``n_chars``, if there is one,
    is counted anew. Texts without repeated bytes stay as they are, NULL too. Words are told apart by 48 bits of a hash: in ten million
    distinct words there is a pair with equal ones with a chance of some 0.2, which only matters where the words around
    it repeat too.
    """
    founds = [(find_repeated(docs, length, doc_id, text), "bytes")]
    if words:
        founds.append((find_repeated_words(docs, words, doc_id, text), "codes"))
    uid = free_name(docs, "_uid")
    return _cut_texts(docs.withColumn(uid, row_uid(docs)), uid, _holes_of(founds), text)


def removal_digests(
    docs: DataFrame, length: int = 400, doc_id: str = "doc_id", text: str = "text", words: int | None = None
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row, when repeated bytes are removed.

    With ``words`` there is one more column, ``cleaned_text``: the text less what is in a string of ``length`` bytes or in a
    sequence of ``words`` words that occurs again (:func:`remove_repeated`). The other columns go by bytes alone.

    Strings are judged on the input. NULL and empty texts and texts below ``length`` have nothing to remove; a row
    that is repeated is removed whole if it is long enough. ``doc_id`` is passed on, NULL as well.
    """
    found = find_repeated(docs, length, doc_id, text)
    kinds = "uid long, n_removed long, n_spans long, kept_sha256 string"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for uid, raw, spans in zip(*(batch.column(c).to_pylist() for c in ("uid", "raw", "spans"))):
                joined = union_spans([(s["start"], s["end"]) for s in spans])
                kept = hashlib.sha256(_cut(raw, joined)).hexdigest()
                out.append((uid, sum(b - a for a, b in joined), len(joined), kept))
            types = [pa.int64()] * 3 + [pa.string()]
            names = [c.split()[0] for c in kinds.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 4, types)], names)

    cut = found.texts.join(found.spans, "uid").mapInArrow(work, kinds)
    both = found.marked.join(cut, "uid", "left")
    empty = hashlib.sha256(b"").hexdigest()
    digests = both.select(
        "uid",
        "doc_id",
        "n_bytes",
        F.when(F.col("whole"), F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("whole"), F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(F.col("whole"), F.lit(empty)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("sha")))).alias("kept_sha256"),
    )
    if not words:
        return digests.drop("uid")
    spans = _holes_of([(found, "bytes"), (find_repeated_words(docs, words, doc_id, text), "codes")])
    texts = docs.select(row_uid(docs).alias("uid"), docs[text].cast("string").alias("cleaned_text"))
    return _cut_texts(digests.join(texts, "uid"), "uid", spans, "cleaned_text")
