"""MinHash near-dedup with banding, signature verification, full confirmation, large-star and small-star.

1. A map over the texts gives each row its number of shingles, a digest of its shingle set and its signature.
2. Rows with the same set are one class, linked through its smallest id; everything below is about classes.
3. Classes that share a band meet in blocks of about ``2 * BLOCK`` rows and ``2 * BLOCK_BYTES`` of text at most, however large the bucket.
   Inside a block, pairs that agree in enough minima are confirmed on the full sets, unless links found
   before already connect them. A block therefore hands on a spanning forest, not all its pairs.
4. Components of those links.

A shingle is known by a 64-bit hash of its words, a set by all its hashes.

Defined results: a null or wordless text has no shingles and is linked with nothing; a text of fewer than
five words is one shingle, its whole sequence; a null doc_id is linked with nothing and stays; rows repeated under
one id are one node if their texts agree, and are linked through the id if not; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.common import binary_parts, pieces, runs, shuffle_partitions, stored, whole_text
from meterlake.llm.components import components
from meterlake.llm.word_hashes import LOWER, mixed, placed_hashes, words

SHINGLE = 5
#: A pair at similarity 0.85 shares none of 20 bands of 4 minima with probability 4e-7, at 0.8 with 2.6e-5.
ROWS, BANDS = 4, 20
MINIMA = ROWS * BANDS
#: A pair at the wanted similarity has fewer agreeing minima than are asked for with at most this probability.
MISSED = 4e-7
BLOCK, BLOCK_BYTES = 256, 32 << 20

_RNG = np.random.default_rng(8)
_A = _RNG.integers(0, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 2**63, MINIMA, dtype=np.uint64)
_PLACES = [np.uint64(x) for x in _RNG.integers(0, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)]


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, bounds = binary_parts(column)
    data = LOWER[data]
    starts, ends, first = words(data, bounds)
    h = placed_hashes(data, starts, ends)
    n = len(h)
    whole = np.zeros(max(0, n - SHINGLE + 1), np.uint64)
    for i, factor in enumerate(_PLACES):
        whole = mixed(whole + h[i : i + len(whole)] * factor)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(whole[a : b - SHINGLE + 1]))
        elif b > a:
            value = np.full(1, b - a, np.uint64)
            for i in range(a, b):
                value = mixed(value + h[i : i + 1] * _PLACES[i - a])
            out.append(value)
        else:
            out.append(np.empty(0, np.uint64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """The high half of the smallest value of each universal hash."""
    least = np.full(MINIMA, 2**64 - 1, np.uint64)
    for i in range(0, len(shingles), 512):
        np.minimum(least, (shingles[i : i + 512, None] * _A + _B).min(0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        sets = shingle_sets(batch.column(1))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                pa.array((np.diff(binary_parts(batch.column(1))[1]) >> 10).astype(np.int32) + 1),
            ],
            names=["doc_id", "n_shingles", "digest", "signature", "kib"],
        )


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, its text's size, band and bucket: a 64-bit hash of each band."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, _ = binary_parts(batch.column(1))
        minima = data.view(np.uint32).reshape(-1, BANDS, ROWS).astype(np.uint64)
        key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), minima.shape[:2]).copy()
        for i in range(ROWS):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + minima[:, :, i])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(batch.column(0).to_numpy(), BANDS)),
                pa.array(np.tile(np.arange(BANDS, dtype=np.int32), batch.num_rows)),
                pa.array(key.reshape(-1).view(np.int64)),
                pa.array(np.repeat(batch.column(2).to_numpy(), BANDS)),
            ],
            names=["node", "band", "bucket", "kib"],
        )


class _Forest:
    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> None:
        self.up[self.root(a)] = self.root(b)


def least_agreeing(percent: int) -> int:
    """How many of the minima a pair must share to be confirmed: 50 of 80 for 85 percent, 45 for 80."""
    p, k, below = percent / 100, 0, 0.0
    while k < MINIMA:
        below += math.comb(MINIMA, k) * p**k * (1 - p) ** (MINIMA - k)
        if below > MISSED:
            break
        k += 1
    return k


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _block_links(percent: int):
    least = least_agreeing(percent)

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links of each block's spanning forest. A pair is looked at in the first of the bands it shares."""
        found: list[tuple[int, int]] = []
        for group in runs(batches, ["band", "bucket", "i", "j"]):
            band, i, j = (group.column(c)[0].as_py() for c in ("band", "i", "j"))
            nodes = group.column("node").to_pylist()
            data, _ = binary_parts(group.column("signature").combine_chunks())
            minima = data.view(np.uint32).reshape(-1, MINIMA)
            part = np.array(group.column("part").to_pylist())
            size = np.array(group.column("n_shingles").to_pylist())
            texts = group.column("text").combine_chunks()
            sets: dict[int, np.ndarray] = {}

            def shingles(k: int, texts=texts, sets=sets) -> np.ndarray:
                if k not in sets:
                    sets[k] = shingle_sets(texts.slice(k, 1))[0]
                return sets[k]

            forest, pairs = _Forest(len(nodes)), []
            for x in range(len(nodes) - 1):
                same = minima[x + 1 :] == minima[x]
                agree = same.sum(1)
                ok = (agree >= least) & (100 * np.minimum(size[x + 1 :], size[x]) >= percent * np.maximum(size[x + 1 :], size[x]))
                if i != j:
                    ok &= part[x + 1 :] != part[x]
                if band:
                    ok &= ~same[:, : band * ROWS].reshape(len(same), band, ROWS).all(2).any(1)
                pairs.extend((-int(agree[y]), x, x + 1 + int(y)) for y in np.flatnonzero(ok))
            for _, x, y in sorted(pairs):
                if forest.root(x) != forest.root(y) and similar(shingles(x), shingles(y), percent):
                    forest.join(x, y)
                    found.append((nodes[x], nodes[y]))
            if len(found) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b"])
                found = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b"])

    return links


def near_groups(spark: SparkSession, docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    rows = texts.mapInArrow(_summaries, "doc_id long, n_shingles long, digest binary, signature binary, kib int")
    rows = stored(spark, rows, "signatures")

    known = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = known.groupBy("digest", "n_shingles").agg(F.min(F.struct("doc_id", "signature", "kib")).alias("first"))
    classes = stored(spark, classes.select("digest", "n_shingles", F.col("first.doc_id").alias("node"), F.col("first.signature").alias("signature"), F.col("first.kib").alias("kib")), "classes")

    banded = classes.select("node", "signature", "kib").mapInArrow(_bands, "node long, band int, bucket long, kib int")
    buckets = banded.groupBy("band", "bucket").agg(F.count("*").alias("rows"), F.sum("kib").alias("total")).where("rows > 1")
    met = banded.drop("kib").join(buckets, ["band", "bucket"])
    blocks = F.ceil(F.greatest(F.col("rows") / BLOCK, F.col("total") * 1024 / BLOCK_BYTES)).cast("int")
    met = met.withColumn("blocks", blocks).withColumn("part", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = met.select("node", "band", "bucket", "part", other.alias("other"))
    met = stored(spark, met.select("node", "band", "bucket", "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j")), "blocks")

    wanted = met.select("node").distinct().join(classes, "node")
    digests = wanted.select(F.col("node").alias("id"), "n_shingles", "signature", "digest")
    read = texts.join(digests, F.col("doc_id") == F.col("id")).select(F.col("id").alias("node"), "n_shingles", "signature", "text", "digest")
    read = read.mapInArrow(_checked, "node long, n_shingles long, signature binary, text string")
    keys = ["band", "bucket", "i", "j"]
    meeting = met.join(read, "node").repartition(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys, "node")
    links = meeting.mapInArrow(_block_links(percent), "a long, b long")

    # Rows under one id with different sets are one node.
    several = known.groupBy("doc_id").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).where("lo <> hi")
    own = known.join(several.select("doc_id"), "doc_id").join(classes.select("digest", "n_shingles", "node"), ["digest", "n_shingles"])
    links = links.unionByName(own.select(F.col("doc_id").alias("a"), F.col("node").alias("b")))
    groups = components(spark, links)

    named = classes.select("digest", "n_shingles", "node").join(groups, "node", "left")
    named = named.select("digest", "n_shingles", F.coalesce("component", "node").alias("group"))
    out = rows.select("doc_id", "n_shingles", "digest").join(named, ["digest", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("group", "doc_id"))
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows whose text has the class's set; others only share its id."""
    for batch in pieces(batches, "text"):
        sets = shingle_sets(batch.column(3))
        digests = batch.column(4).to_pylist()
        same = [xxhash.xxh3_128_digest(s.tobytes()) == d for s, d in zip(sets, digests, strict=True)]
        yield batch.filter(pa.array(same)).select(["node", "n_shingles", "signature", "text"])


def near_distinct_documents(spark: SparkSession, docs: DataFrame, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` that stay: one row of each component, rows without an id or words all."""
    kept = near_groups(spark, docs, percent).where("kept AND n_shingles > 0").select(F.col("doc_id").alias("__id")).distinct()
    has_words = whole_text().rlike(r"[^\x20\x09-\x0D]")
    free = docs.where(~has_words | F.col("doc_id").isNull())
    one = docs.where(has_words & F.col("doc_id").isNotNull()).join(kept, F.col("doc_id") == F.col("__id"), "left_semi")
    return one.unionByName(free)
