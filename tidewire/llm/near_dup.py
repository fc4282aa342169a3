"""Near duplicates: consistent weighted samples of TF-IDF shingles, banded, verified by weighted Jaccard similarity.

1. Documents are read once, in blocks. Hashes of their word shingles go to parts of the hash space, where documents
   per shingle are counted; only shingles of two or more documents come back. The rest cannot be shared, so a
   document's total weight is enough to know about them.
2. A document can be similar to another at ``s`` only if shared shingles hold ``s`` of its weight: the others are
   alone. Documents with equal shingles become one vector.
3. Each vector is sampled consistently in proportion to its weights; samples are put in bands, equal bands meet.
4. In each bucket all members are compared with its most typical one. A member that is not similar to it is then
   compared with all others that met the same one, block by block, since it may be similar to them.
5. Links make components; a component is a class.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import bounded_batches, free_name, numbered, row_uid
from .components import components
from .parts import HASH_BITS, blocks, cut_parts, lean, mix, pack, pack_ids, unpack, unpack_ids
from .token_counts import Numbers

#: Shingles that a part of the hash space has on average, and bytes of text in a block. Their arrays take some 20 times as
#: much memory as the text.
PART_SHINGLES, SHINGLED_BYTES = 500_000, 3_000_000
#: Bytes of an Arrow batch. Both sides hold several batches for each task.
ARROW_BYTES = 8_000_000
#: Rows that are sent at once: a block's parts are packed as they go out, never all at a time.
SENT_ROWS = 32
#: Shingles of the vectors that a comparison block has on average.
COMPARED = 200_000
SENT = "part long, block long, entries binary, times binary, uids binary, ids binary, totals binary"
REPLY = "block long, keys binary, times binary, shared binary, uids binary, ids binary, totals binary"
VECTOR = "uid long, doc_id long, typical double, weight double, print binary, shingles binary, weights binary"


@dataclass(frozen=True)
class Likeness:
    """Shingles of ``words`` words; links from ``least`` on; ``bands`` of ``rows`` samples find them.

    IDF is scaled to 1 .. 1 + ``idf``: frequent shingles weigh less, but the few words in which a copy differs, which
    nobody else has, do not outweigh what it shares. At the least similarity a link is missed with a chance of
    (1 - 0.8 ** 4) ** 18, below 0.0001.
    """

    words: int = 5
    least: float = 0.8
    bands: int = 18
    rows: int = 4
    idf: float = 0.2


def shingle_keys(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash and ordinal of the document in one number, times) of each distinct shingle of each document, sorted.

    A text of fewer words is one shingle; one without words has none.
    """
    numbers = Numbers()
    docs = [np.fromiter(map(numbers.__getitem__, raw.split()), np.int64) for raw in texts]
    lengths = np.array([len(d) for d in docs], np.int64)
    flat = np.concatenate(docs) if docs else np.array([], np.int64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, numbers), np.uint64, len(numbers))[flat]
    owner = np.repeat(np.arange(len(docs), dtype=np.uint64), lengths)
    factor, rolled = np.uint64(0x9E3779B97F4A7C15), np.zeros(max(0, len(flat) - words + 1), np.uint64)
    for i in range(words):
        rolled = rolled * factor + hashes[i : i + len(rolled)]
    whole = owner[words - 1 :] == owner[: len(rolled)] if len(rolled) else np.array([], bool)
    found, of = [rolled[whole]], [owner[: len(rolled)][whole]]
    starts = np.cumsum(lengths) - lengths
    for doc in np.flatnonzero((lengths > 0) & (lengths < words)).tolist():
        value = np.array([lengths[doc]], np.uint64)
        for word in range(starts[doc], starts[doc] + lengths[doc]):
            value = value * factor + hashes[word : word + 1]
        found.append(value)
        of.append(np.array([doc], np.uint64))
    high = mix(np.concatenate(found)) >> np.uint64(64 - HASH_BITS)
    return np.unique(high << np.uint64(16) | np.concatenate(of), return_counts=True)


def _idf(shared: np.ndarray, docs: int, spread: float) -> np.ndarray:
    return 1 + spread * (np.log((1 + docs) / (1 + shared)) / np.log(1 + docs))


def _send(rows: DataFrame, parts: int, words: int) -> DataFrame:
    """A header row per block, then a row for each block and part of the hash space. A block is known by its first uid."""
    names = [c.split()[0] for c in SENT.split(", ")]
    types = [pa.int64()] * 2 + [pa.binary()] * 5

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=1).compress
        for held in blocks(batches, "raw", SHINGLED_BYTES):
            uids, block, count = np.array(held["uid"], "<i8").tobytes(), held["uid"][0], len(held["uid"])
            ids, texts = pack_ids(held["doc_id"]), held.pop("raw")
            keys, times = shingle_keys(texts, words)
            del texts
            owner = (keys & np.uint64(0xFFFF)).astype(np.int64)
            totals = np.bincount(owner, weights=times, minlength=count).astype("<i8").tobytes()
            del owner
            # A part of its own takes the header past the counting.
            out = [(-1 - block, block, None, None, uids, ids, totals)]
            for part, low, high in cut_parts(keys, parts):
                held_times = compress(times[low:high].astype("<u4").tobytes())
                out.append((part, block, pack(keys[low:high]), held_times, None, None, None))
                if len(out) == SENT_ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    bounded_batches(rows.sparkSession, ARROW_BYTES)
    return rows.select("uid", "doc_id", "raw").mapInArrow(work, SENT)


def _count(part: pa.Table) -> pa.Table:
    """What a part of the hash space says to each block: its shingles that two or more documents hold, and how many."""
    names = [c.split()[0] for c in REPLY.split(", ")]
    types = [pa.int64()] + [pa.binary()] * 6
    rows = list(zip(*(part.column(c).to_pylist() for c in ("block", "entries", "times", "uids", "ids", "totals"))))
    if part.column("part")[0].as_py() < 0:
        out = [(block, None, None, None, *header) for block, _, _, *header in rows]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
    keys = [unpack(row[1]) for row in rows]
    _, at, counts = np.unique(np.concatenate(keys) >> np.uint64(16), return_inverse=True, return_counts=True)
    shared = counts[at].astype("<u4")
    out, low = [], 0
    for (block, _, times, *_), own in zip(rows, keys):
        here = shared[low : low + len(own)]
        low += len(own)
        more = here > 1
        if more.any():
            held = np.frombuffer(zstandard.ZstdDecompressor().decompress(times), "<u4")
            found = own[more].astype("<u8").tobytes(), held[more].tobytes(), here[more].tobytes()
            out.append((block, *found, None, None, None))
    return pa.table([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 7, types)], names)


def vectors(rows: DataFrame, like: Likeness) -> DataFrame:
    """One row per document; those that may have a near copy also have their shared shingles and weights.

    ``print`` is equal for equal vectors, ``typical`` the smaller the more of a document many others have.
    """
    size, count = rows.select(F.sum(F.octet_length("raw")), F.count("*")).first()
    parts = max(64, (size or 0) // 6 // PART_SHINGLES)
    names = [c.split()[0] for c in VECTOR.split(", ")]
    types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.binary(), pa.binary()]
    least, spread = like.least, like.idf

    def block_vectors(block: pa.Table) -> pa.Table:
        cells = {c: block.column(c).to_pylist() for c in block.column_names}
        header = next(i for i, h in enumerate(cells["uids"]) if h is not None)
        totals, uids = (np.frombuffer(cells[c][header], "<i8") for c in ("totals", "uids"))
        ids = unpack_ids(cells["ids"][header]).to_pylist()
        join = lambda c, t: np.frombuffer(b"".join(x for x in cells[c] if x), t)
        keys, times, shared = join("keys", "<u8"), join("times", "<u4"), join("shared", "<u4")
        owner = (keys & np.uint64(0xFFFF)).astype(np.int64)
        order = np.lexsort((keys, owner))
        keys, times, owner = keys[order], times[order].astype(np.int64), owner[order]
        idf = _idf(shared[order], count, spread)
        inside = np.bincount(owner, weights=times * idf, minlength=len(totals))
        alone = totals - np.bincount(owner, weights=times, minlength=len(totals))
        weight = inside + alone * _idf(np.array([1.0]), count, spread)[0]
        # A shingle held n times is n elements of the same weight: weights of a set, with which all later steps work.
        first = np.cumsum(times) - times
        turn = np.arange(times.sum()) - np.repeat(first, times)
        hashes = mix(np.repeat(keys >> np.uint64(16), times) + turn.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        weights = np.repeat(idf, times).astype("<f8")
        cuts = np.searchsorted(np.repeat(owner, times), np.arange(len(totals) + 1)).tolist()
        out = []
        for doc in range(len(totals)):
            uid, key = int(uids[doc]), ids[doc]
            low, high = cuts[doc], cuts[doc + 1]
            if not totals[doc] or inside[doc] >= (least - 1e-9) * weight[doc]:
                rank = np.argsort(hashes[low:high])
                own = hashes[low:high][rank].astype("<u8").tobytes()
                # Shingles that nobody else has are not in the vector: who has some is equal to none.
                which = uid if alone[doc] else -1
                mark = hashlib.blake2b(own + which.to_bytes(8, "little", signed=True), digest_size=16).digest()
                typical = weight[doc] / totals[doc] if totals[doc] else 0.0
                out.append((uid, key, typical, float(weight[doc]), mark, own, weights[low:high][rank].tobytes()))
            else:
                out.append((uid, key, None, None, None, None, None))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    sent = _send(rows, parts, like.words)
    replies = sent.groupBy("part").applyInArrow(lean(_count), REPLY)
    return replies.groupBy("block").applyInArrow(lean(block_vectors), VECTOR)


def samples(hashes: np.ndarray, weights: np.ndarray, first: int, count: int) -> np.ndarray:
    """Improved consistent weighted samples ``first`` .. ``first + count``: a hash of (element, quantized weight) each.

    For element k and sample j, r and c are Gamma(2, 1) and b uniform, all drawn from the hash of (k, j);
    t = floor(ln w / r + b), ln y = r (t - b), and the sample is the (k, t) with the least ln c - ln y - r.
    """
    seeds = mix(np.arange(first, first + count, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    base = hashes[None, :] ^ seeds[:, None]

    def uniform(salt: int) -> np.ndarray:
        return ((mix(base + np.uint64(salt)) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53

    r = -np.log(uniform(0x51) * uniform(0x52))
    t = np.floor(np.log(weights)[None, :] / r + (b := uniform(0x55)))
    value = np.log(-np.log(uniform(0x53) * uniform(0x54))) - r * (t - b) - r
    best = value.argmin(axis=1)
    at = np.arange(count)
    return mix(base[at, best] + t[at, best].astype(np.int64).view(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def signature(hashes: np.ndarray, weights: np.ndarray, count: int, at_once: int = 400_000) -> np.ndarray:
    step = max(1, at_once // max(1, len(hashes)))
    return np.concatenate([samples(hashes, weights, j, min(step, count - j)) for j in range(0, count, step)])


def band_keys(reps: DataFrame, like: Likeness) -> DataFrame:
    """(band, typical, uid): a row per vector and band."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, typical, uids = [], [], []
            cells = (batch.column(c).to_pylist() for c in ("uid", "typical", "shingles", "weights"))
            for uid, value, shingles, weights in zip(*cells):
                if shingles:
                    drawn = signature(np.frombuffer(shingles, "<u8"), np.frombuffer(weights, "<f8"), like.bands * like.rows)
                    band = np.arange(like.bands, dtype=np.uint64)
                    for row in drawn.reshape(like.bands, like.rows).T:
                        band = mix(band * np.uint64(0x9E3779B97F4A7C15) + row)
                    keys.append(band.view(np.int64))
                    typical += [value] * like.bands
                    uids += [uid] * like.bands
            flat = np.concatenate(keys) if keys else np.array([], np.int64)
            arrays = [pa.array(flat), pa.array(typical, pa.float64()), pa.array(uids, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["band", "typical", "uid"])

    return reps.mapInArrow(work, "band long, typical double, uid long")


def common_weight(a: np.ndarray, weights: np.ndarray, b: np.ndarray) -> float:
    """The weight of the elements that two sorted sets share."""
    if len(a) == 0 or len(b) == 0:
        return 0.0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return float(weights[b[at] == a].sum())


def _verify(pairs: DataFrame, least: float) -> DataFrame:
    """``similar`` for rows with both vectors: shared weight by the weight that either has."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = (batch.column(c).to_pylist() for c in ("u_shingles", "u_weights", "u_weight", "v_shingles", "v_weight"))
            found = []
            for shingles, weights, weight, others, other in zip(*cells):
                a, w, b = (np.frombuffer(x, t) for x, t in ((shingles, "<u8"), (weights, "<f8"), (others, "<u8")))
                both = common_weight(a, w, b)
                found.append(both >= (least - 1e-9) * (weight + other - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column("u"), batch.column("v"), pa.array(found, pa.bool_())], ["u", "v", "similar"]
            )

    return pairs.mapInArrow(work, "u long, v long, similar boolean")


def _side(vecs: DataFrame, name: str) -> DataFrame:
    return vecs.select(F.col("uid").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("shingles", "weights", "weight")])


def _blocks(members: DataFrame, vecs: DataFrame, name: str) -> DataFrame:
    """(pivot, packed vectors): the members of each pivot in blocks of about :data:`COMPARED` shingles."""
    joined = members.join(vecs.select("uid", "weight", "shingles", "weights"), "uid")
    sizes = joined.groupBy("pivot").agg(F.ceil(F.sum(F.octet_length("shingles")) / (8 * COMPARED)).alias("n"))
    dealt = joined.join(sizes, "pivot").withColumn("_block", F.pmod(F.xxhash64("uid"), F.greatest("n", F.lit(1))))
    item = F.struct("uid", "weight", "shingles", "weights")
    return dealt.groupBy("pivot", "_block").agg(F.collect_list(item).alias(name)).drop("_block")


def compare_blocks(left: list[dict], right: list[dict], least: float, at_once: int = 4_096) -> list[tuple[int, int]]:
    """Pairs of a left and a right vector that are similar: shared weights of all pairs as products of matrices."""
    sets = [[np.frombuffer(x["shingles"], "<u8") for x in side] for side in (left, right)]
    weights = np.concatenate([np.frombuffer(x["weights"], "<f8") for x in left])
    elements = np.concatenate(sets[0])
    known, index = np.unique(elements, return_index=True)
    both = np.intersect1d(known, np.unique(np.concatenate(sets[1])), assume_unique=True)
    value = weights[index[np.searchsorted(known, both)]]
    shared = np.zeros((len(left), len(right)))
    for low in range(0, len(both), at_once):
        some = both[low : low + at_once]
        held = [np.array([np.isin(some, s, assume_unique=True) for s in side], np.float64) for side in sets]
        shared += (held[0] * value[low : low + at_once]) @ held[1].T
    total = np.array([x["weight"] for x in left])[:, None] + np.array([x["weight"] for x in right])[None, :] - shared
    hits = np.argwhere(shared >= (least - 1e-9) * total)
    return [(left[i]["uid"], right[j]["uid"]) for i, j in hits.tolist() if left[i]["uid"] != right[j]["uid"]]


def _rest(met: DataFrame, verified: DataFrame, vecs: DataFrame, least: float) -> DataFrame:
    """Links of members that are not similar to the pivot of a bucket, with all others that met that pivot."""
    pivots = verified.where("NOT similar").select(F.col("u").alias("pivot"), F.col("v").alias("uid"))
    many = met.groupBy(F.col("u").alias("pivot")).count().where("count > 1").select("pivot")
    left = pivots.join(many, "pivot", "left_semi")
    everyone = met.select(F.col("u").alias("pivot"), F.col("v").alias("uid"))
    right = everyone.join(left.select("pivot").distinct(), "pivot", "left_semi")
    blocks = _blocks(left, vecs, "resid").join(_blocks(right, vecs, "member"), "pivot")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                pairs = compare_blocks(batch.column("resid")[row].as_py(), batch.column("member")[row].as_py(), least)
                columns = list(zip(*pairs)) or [(), ()]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["u", "v"])

    return blocks.select("resid", "member").mapInArrow(work, "u long, v long")


def links(vecs: DataFrame, like: Likeness) -> DataFrame:
    """(u, v) links between different vectors, enough to connect all that are similar and met in a band."""
    bands = materialize(band_keys(vecs, like), "bands")
    # The most typical member of a bucket, such as the text that all others were copied from, is its pivot.
    pivot = bands.groupBy("band").agg(F.min(F.struct("typical", "uid"))["uid"].alias("u"), F.count("*").alias("n"))
    met = bands.join(pivot.where("n > 1").drop("n"), "band").where("uid != u").select("u", F.col("uid").alias("v"))
    met = materialize(met.distinct(), "met")
    both = met.join(_side(vecs, "u"), "u").join(_side(vecs, "v"), "v")
    verified = materialize(_verify(both, like.least), "verified")
    return verified.where("similar").select("u", "v").unionByName(_rest(met, verified, vecs, like.least))


def near_duplicates(
    docs: DataFrame, like: Likeness | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, class_id, class_size, kept, uid): one row per document.

    Documents that are linked, directly or over others, share a class; its id is its least ``doc_id``, and the first
    row with that id is kept. Documents without words (NULL and empty ones) are one class, so are repeated rows; a
    NULL ``doc_id`` counts as larger than any other. ``docs`` should read a stored table: ``uid`` numbers its rows by
    input partition.
    """
    like = like or Likeness()
    every = materialize(vectors(numbered(docs, doc_id, text), like), "vectors")
    some = every.where(F.col("print").isNotNull())
    first = Window.partitionBy("print").orderBy("uid")
    reps = materialize(
        some.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n", "doc_id"), "vectors-once"
    )
    roots = components(links(reps, like))
    rep_class = reps.select("print", "uid").join(roots, F.col("uid") == F.col("node"), "left")
    rep_class = rep_class.select("print", F.coalesce("root", "uid").alias("root"))
    members = materialize(some.select("uid", "doc_id", "print").join(rep_class, "print").drop("print"), "members")
    heads = members.groupBy("root").agg(
        F.min(F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)), F.col("uid").alias("uid"), F.col("doc_id").alias("id"))).alias("head"),
        F.count("*").alias("class_size"),
    )
    # Stored before the join: else the join would use the grouping's partitions, in which Spark cannot split a hot class.
    heads = materialize(heads, "heads")
    shared = members.join(heads, "root").select(
        "doc_id", F.col("head.id").alias("class_id"), "class_size", (F.col("uid") == F.col("head.uid")).alias("kept"), "uid"
    )
    alone = every.where(F.col("print").isNull()).select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("kept"), "uid"
    )
    return shared.unionByName(alone)


def classes(docs: DataFrame, like: Likeness | None = None) -> DataFrame:
    """:func:`near_duplicates` without the row number."""
    return near_duplicates(docs, like).drop("uid")


def drop_near_duplicates(docs: DataFrame, like: Likeness | None = None) -> DataFrame:
    """The kept document of each class, all columns as they were. ``docs`` should read a stored table."""
    uid = free_name(docs, "_uid")
    gone = near_duplicates(docs, like).where(~F.col("kept")).select(F.col("uid").alias(uid))
    rows = docs.withColumn(uid, row_uid(docs))
    return rows.join(gone, uid, "left_anti").drop(uid)
