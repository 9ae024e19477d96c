"""Token ids as files, with keyed access through a minimal perfect hash.

Files of one folder:

* ``shard-N.ids``: the ids of documents in ascending order of doc_id, one after the other, each document followed by
  the end id; little-endian unsigned numbers of 16 bits if the vocabulary fits, else 32. Nothing else is in it.
* ``shard-N.pos``: where each document of the shard starts, in ids (64 bits each), and the end of the last.
* ``shards/``: Parquet, one row per shard: documents, ids, ids in all shards before. ``layout/``: one row, how an id is stored and
  over how many files the index is spread.
* ``index-N.mph``: keys whose hash falls to N. Bit arrays by level give each key its slot: a key takes the place its
  hash names on the first level where no other key of that level wants it; the slot is the number of set bits before. A
  slot holds a fingerprint of its key and the first and last place of the key's documents (shard, row).

A lookup reads one slot, rejects a key whose fingerprint differs (a stranger passes with probability 2**-32), and
then the places and ids it names. Documents that share a doc_id follow each other, over as many
shards as they fill, and each shard's share is read by itself.

Tasks write a file under a name of their own and rename it, so a task that is run again, or twice, leaves the same
file. Encoding is by the tokenizers library; texts are cut at spaces after a character that is no white space, where the
pre-tokenizer always ends a match, and each distinct part is encoded once.

Defined results: a null text is empty, so its ids are the end id; a null doc_id is a key of its own, before all others; documents with
the same doc_id are ordered by a hash of the text, then the text, and all come back; strings of special tokens inside a text are
ordinary text; an empty table gives no shard and no rows; further columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import struct
import sys
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake.llm.common import binary_parts, pieces, stored, whole_text
from meterlake.llm.part_cache import PartCache
from meterlake.sources.landing import filesystem_opener

END_ID = 0
KEYS_PER_INDEX = 1 << 18
CACHE_ENTRIES = 300_000
READ_BYTES = 4 << 20
PARTS_TOGETHER = 2_000
PIECE_BYTES = 2 << 20
SPACE_MARK = "\u0120"  # a space at the start of a token, as byte-level vocabularies write it
_MAGIC = b"IDSMPH1\0"
_SPARSE = 2  # places per key on each level
_MOST_LEVELS = 64
_SLOT = np.dtype([("print", "<u4"), ("first_shard", "<u4"), ("first_row", "<u8"), ("last_shard", "<u4"), ("last_row", "<u8")])


# ---------------------------------------------------------------- texts to ids


class Encoder:
    """Texts to ids by the tokenizers library, part by part."""

    def __init__(self, description: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(description)
        self.tokenizer.encode_special_tokens = True
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.cache = PartCache(self._parts, CACHE_ENTRIES)
        self.begins = np.zeros(self.tokenizer.get_vocab_size(), bool)  # ids whose token starts with a space
        self.begins[[i for token, i in self.tokenizer.get_vocab().items() if token.startswith(SPACE_MARK)]] = True
        self.end = np.array([END_ID], self.kind).tobytes()
        self.odd = "[" + "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace()) + "] "
        self.cut = re.compile(r"(?<=\S) ").split

    def _ids(self, texts: list[str]) -> Iterator[bytes]:
        for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            yield np.array(found.ids, self.kind).tobytes()

    def _parts(self, parts: list[str]) -> Iterator[bytes]:
        """The ids of a space and each part.

        Parts without a space, that no white space ends, are encoded many at a time: there a token that starts with a space starts a part.
        """
        plain, apart = [], {}
        for part in parts:
            if part and " " not in part and not part[-1].isspace():
                plain.append(part)
            else:
                apart[part] = next(self._ids([" " + part]))
        together = self._plain(plain)
        for part in parts:
            yield apart[part] if part in apart else next(together)

    def _plain(self, parts: list[str]) -> Iterator[bytes]:
        for start in range(0, len(parts), PARTS_TOGETHER):
            some = parts[start : start + PARTS_TOGETHER]
            ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(some)], add_special_tokens=False)[0].ids, np.int64)
            begins = np.flatnonzero(self.begins[ids]) * self.kind.itemsize
            if len(begins) != len(some):
                raise ValueError("the tokenizer joins words across spaces")
            data, bounds = ids.astype(self.kind).tobytes(), [*begins.tolist(), len(ids) * self.kind.itemsize]
            yield from [data[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def _split(self, texts: pa.Array) -> pa.Array:
        """The parts of each text: cut at spaces, but not at those after white space."""
        plans = pc.split_pattern(texts, " ")
        odd = np.flatnonzero(pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False))
        if not len(odd):
            return plans
        order = np.arange(len(texts))
        order[odd] = len(texts) + np.arange(len(odd))
        other = pa.array([self.cut(text) for text in texts.take(pa.array(odd)).to_pylist()], plans.type)
        return pa.concat_arrays([plans, other]).take(pa.array(order))

    def encode(self, texts: pa.Array) -> tuple[bytes, np.ndarray]:
        """The ids of all texts, each with the end id, one after the other, and how many each text has; no null among them.

        Parts travel as numbers, so that Python sees each distinct part of ``texts`` once.
        """
        plans = self._split(texts)
        parts, sizes = plans.flatten(), plans.value_lengths().to_numpy()
        first = np.cumsum(sizes, dtype=np.int64) - sizes
        inner = np.ones(len(parts), bool)
        inner[first] = False
        coded = parts.filter(pa.array(inner)).dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # to_pylist takes ten times as long
        known = self.cache.results(set(names))
        # An end id before each text's first part stands after the text before.
        heads = [self.end + head for head in self._ids(parts.take(pa.array(first)).to_pylist())]
        place = np.empty(len(parts), np.int64)
        place[inner] = coded.indices.to_numpy()
        place[first] = len(names) + np.arange(len(heads))
        data, ends = binary_parts(pa.array([*map(known.__getitem__, names), *heads], pa.large_binary()).take(pa.array(place)))
        starts = ends[:-1][first]
        return data[len(self.end) :].tobytes() + self.end, np.diff(starts, append=ends[-1]) // self.kind.itemsize


@lru_cache(maxsize=2)
def _encoder(description: str) -> Encoder:
    return Encoder(description)


# ---------------------------------------------------------------- the minimal perfect hash


def _places(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    h = hashes + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 2**64 - 1)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((h ^ (h >> np.uint64(31))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Slots 0 to n - 1 of n distinct 64-bit hashes."""

    def __init__(self, sizes: list[int], words: list[np.ndarray]) -> None:
        self.sizes, self.words = sizes, words
        ones = [np.bitwise_count(w).astype(np.int64) for w in words]
        before = np.cumsum([0, *[int(o.sum()) for o in ones]])
        self.ranks = [b + np.cumsum(o) - o for b, o in zip(before, ones, strict=False)]

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        sizes, words, left = [], [], hashes
        while len(left):
            if len(sizes) == _MOST_LEVELS:
                raise ValueError("two keys have the same hash")
            size = -(-max(_SPARSE * len(left), 64) // 64) * 64
            places = _places(left, len(sizes), size)
            alone = np.bincount(places, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            left = left[~alone[places]]
        return cls(sizes, words)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each hash, -1 for one that takes none on any level."""
        out, left = np.full(len(hashes), -1, np.int64), np.arange(len(hashes))
        for level, (size, words, ranks) in enumerate(zip(self.sizes, self.words, self.ranks, strict=True)):
            places = _places(hashes[left], level, size)
            word, bit = words[places >> 6], (places & 63).astype(np.uint64)
            taken = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[left[taken]] = ranks[places[taken] >> 6] + below[taken]
            left = left[~taken]
        return out


def index_bytes(hashes: np.ndarray, prints: np.ndarray, entries: np.ndarray) -> bytes:
    """The file of an index."""
    perfect = PerfectHash.build(hashes)
    slots = np.zeros(len(hashes), _SLOT)
    entries = entries.copy()
    entries["print"] = prints
    slots[perfect.slots(hashes)] = entries
    head = _MAGIC + struct.pack("<QQ", len(hashes), len(perfect.sizes)) + np.array(perfect.sizes, "<u8").tobytes()
    return head + b"".join(w.tobytes() for w in perfect.words) + slots.tobytes()


def read_index(data: bytes) -> tuple[PerfectHash, np.ndarray]:
    if data[:8] != _MAGIC:
        raise ValueError("not an index of token files")
    n, levels = struct.unpack_from("<QQ", data, 8)
    at = 24 + 8 * levels
    sizes, words = np.frombuffer(data, "<u8", levels, 24).astype(int).tolist(), []
    for size in sizes:
        words.append(np.frombuffer(data, "<u8", size // 64, at))
        at += size // 8
    return PerfectHash(sizes, words), np.frombuffer(data, _SLOT, n, at)


# ---------------------------------------------------------------- writing


def hashed(key: Column) -> tuple[Column, Column]:
    """Two hashes of a key: one chooses index and slot, the other is the fingerprint."""
    text = F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit(""))
    return F.xxhash64(F.lit(1), text), F.xxhash64(F.lit(2), text).bitwiseAND(F.lit(0xFFFFFFFF))


def _replace(open_filesystem, path: str, data: bytes) -> None:
    filesystem, inner = open_filesystem(path)
    own = f"{inner}.{uuid.uuid4().hex}"
    with filesystem.open_output_stream(own) as out:
        out.write(data)
    filesystem.move(own, inner)


def write_shards(spark: SparkSession, docs: DataFrame, folder: str, tokenizer_path: str) -> DataFrame:
    """Writes the shards; returns shard, row, doc_id and n of every document."""
    with open(tokenizer_path, encoding="utf-8") as held:
        description = spark.sparkContext.broadcast(held.read())
    # Arrow's file systems make no parent folders on their own.
    spark.range(1).coalesce(1).write.parquet(f"{folder}/started")
    open_filesystem = filesystem_opener()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = _encoder(description.value), TaskContext.get().partitionId()
        filesystem, inner = open_filesystem(f"{folder}/shard-{shard:06d}.ids")
        own, out, counts = f"{inner}.{uuid.uuid4().hex}", None, []
        written = 0
        for batch in pieces(batches, "text", PIECE_BYTES):
            out = out or filesystem.open_output_stream(own)
            ids, lengths = encoder.encode(batch.column(1))
            out.write(ids)
            counts.append(lengths)
            rows = np.arange(written, written + len(lengths), dtype=np.int64)
            written += len(lengths)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(rows), shard, np.int32)), pa.array(rows), batch.column(0), pa.array(lengths)], ["shard", "row", "doc_id", "n"]
            )
        if out:
            out.close()
            filesystem.move(own, inner)
            _replace(open_filesystem, f"{folder}/shard-{shard:06d}.pos", np.cumsum(np.concatenate([[0], *counts])).astype("<u8").tobytes())

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    return stored(spark, ordered.mapInArrow(write, "shard int, row long, doc_id long, n long"), "token-rows")


def write_shard_list(rows: DataFrame, folder: str) -> None:
    """One row per shard, and how many ids stand before it."""
    each = rows.groupBy("shard").agg(F.count("*").alias("documents"), F.sum("n").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    each.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0))).coalesce(1).write.parquet(f"{folder}/shards")


def write_index(spark: SparkSession, rows: DataFrame, folder: str) -> int:
    """Writes the index; returns over how many files it is spread. No key at all, no file."""
    place = F.struct("shard", "row")
    keys = stored(spark, rows.groupBy("doc_id").agg(F.min(place).alias("first"), F.max(place).alias("last")), "token-keys")
    parts = max(1, -(-keys.count() // KEYS_PER_INDEX))
    slot, stamp = hashed(F.col("doc_id"))
    hashes = keys.select(
        slot.alias("h"), stamp.alias("print"), F.pmod(F.shiftright(slot, 32), F.lit(parts)).cast("int").alias("index"),
        "first.shard", "first.row", F.col("last.shard").alias("last_shard"), F.col("last.row").alias("last_row"),
    )
    open_filesystem = filesystem_opener()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[list[np.ndarray]]] = {}
        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns]
            for index in np.unique(columns[2]).tolist():
                mine = columns[2] == index
                held.setdefault(index, []).append([c[mine] for c in columns])
        for index, parts_of in held.items():
            h, stamp, _, *places = (np.concatenate(c) for c in zip(*parts_of, strict=True))
            entries = np.zeros(len(h), _SLOT)
            for name, values in zip(_SLOT.names[1:], places, strict=True):
                entries[name] = values
            _replace(open_filesystem, f"{folder}/index-{index:06d}.mph", index_bytes(h.view(np.uint64), stamp.astype(np.uint32), entries))
            yield pa.RecordBatch.from_arrays([pa.array([index], pa.int32()), pa.array([len(h)], pa.int64())], ["index", "keys"])

    stored(spark, hashes.repartition(parts, "index").mapInArrow(build, "index int, keys long"), "token-indexes")
    return parts


def write_token_files(spark: SparkSession, docs: DataFrame, folder: str, tokenizer_path: str) -> None:
    """All files below ``folder``, the layout last."""
    rows = write_shards(spark, docs, folder, tokenizer_path)
    write_shard_list(rows, folder)
    layout = (id_kind(tokenizer_path), write_index(spark, rows, folder))
    spark.createDataFrame([layout], "kind string, indexes int").coalesce(1).write.parquet(f"{folder}/layout")


# ---------------------------------------------------------------- keyed access


def located(keys: DataFrame, folder: str, indexes: int) -> DataFrame:
    """doc_id, shard, row and end row of each shard's share of each key of ``keys`` (doc_id, distinct) that is in the files."""
    slot, stamp = hashed(F.col("doc_id"))
    asked = keys.select("doc_id", slot.alias("h"), stamp.alias("print"), F.pmod(F.shiftright(slot, 32), F.lit(indexes)).cast("int").alias("index"))
    open_filesystem = filesystem_opener()

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, perfect, slots = -1, None, None
        for batch in batches:
            index = batch.column(3).to_numpy()
            for at in np.split(np.arange(len(index)), np.flatnonzero(np.diff(index)) + 1):
                if not len(at):
                    continue
                if index[at[0]] != opened:
                    opened = int(index[at[0]])
                    filesystem, inner = open_filesystem(f"{folder}/index-{opened:06d}.mph")
                    perfect = None
                    if filesystem.get_file_info(inner).is_file:
                        with filesystem.open_input_file(inner) as source:
                            perfect, slots = read_index(source.read())
                if perfect is None:  # no key of the files falls here
                    continue
                found = perfect.slots(batch.column(1).to_numpy()[at].view(np.uint64))
                here = np.flatnonzero(found >= 0)
                entries = slots[found[here]]
                here = here[entries["print"] == batch.column(2).to_numpy()[at][here].astype(np.uint32)]
                entries = slots[found[here]]
                columns = [pa.array(entries[n].astype(np.int64)) for n in _SLOT.names[1:]]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at[here])), *columns], ["doc_id", *_SLOT.names[1:]])

    found = asked.repartition("index").sortWithinPartitions("index").mapInArrow(
        look, "doc_id long, first_shard long, first_row long, last_shard long, last_row long"
    )
    shards = found.withColumn("shard", F.explode(F.sequence("first_shard", "last_shard")))
    row = F.when(F.col("shard") == F.col("first_shard"), F.col("first_row")).otherwise(0)
    end = F.when(F.col("shard") == F.col("last_shard"), F.col("last_row") + 1)
    return shards.select("doc_id", "shard", row.alias("row"), end.alias("end_row"))


RECORDS = "doc_id long, shard long, offset long, ids binary"


def records(places: DataFrame, folder: str, kind: str) -> DataFrame:
    """doc_id, shard, offset in it and ids of every document at ``places``; neighbours are read together."""
    open_filesystem = filesystem_opener()
    size = np.dtype(kind).itemsize

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, ends, source = -1, None, None
        for batch in batches:
            rows: list[tuple] = []
            for key, shard, row, end_row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if shard != opened:
                    if rows:
                        yield from _read_rows(source, ends, size, opened, rows)
                    if source:
                        source.close()
                    opened, rows = shard, []
                    filesystem, inner = open_filesystem(f"{folder}/shard-{shard:06d}.pos")
                    with filesystem.open_input_file(inner) as held:
                        ends = np.frombuffer(held.read(), "<u8").astype(np.int64)
                    filesystem, inner = open_filesystem(f"{folder}/shard-{shard:06d}.ids")
                    source = filesystem.open_input_file(inner)
                rows.append((key, row, len(ends) - 1 if end_row is None else end_row))
            if rows:
                yield from _read_rows(source, ends, size, opened, rows)
        if source:
            source.close()

    return places.repartition("shard").sortWithinPartitions("shard", "row").mapInArrow(read, RECORDS)


def _read_rows(source: pa.NativeFile, ends: np.ndarray, size: int, shard: int, asked: list[tuple]) -> Iterator[pa.RecordBatch]:
    """The documents of row ranges in ascending order."""
    single = [(key, row) for key, first, stop in asked for row in range(first, stop)]
    start = 0
    while start < len(single):
        stop = start + 1
        base = ends[single[start][1]]
        while stop < len(single) and single[stop][1] == single[stop - 1][1] + 1 and (ends[single[stop][1] + 1] - base) * size <= READ_BYTES:
            stop += 1
        last = ends[single[stop - 1][1] + 1]
        data = source.read_at(int(last - base) * size, int(base) * size)
        keys = pa.array([k for k, _ in single[start:stop]], pa.int64())
        at = ends[[r for _, r in single[start:stop]] + [single[stop - 1][1] + 1]]
        ids = pa.array([data[int(a - base) * size : int(b - base) * size] for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())
        yield pa.RecordBatch.from_arrays([keys, pa.array(np.full(len(keys), shard, np.int64)), pa.array(at[:-1]), ids], ["doc_id", "shard", "offset", "ids"])
        start = stop


def id_kind(tokenizer_path: str) -> str:
    """How one id is stored."""
    with open(tokenizer_path, encoding="utf-8") as held:
        model = json.load(held)
    most = max([*model["model"]["vocab"].values(), *[t["id"] for t in model.get("added_tokens", [])]])
    return "<u2" if most < 1 << 16 else "<u4"


def layout_of(spark: SparkSession, folder: str) -> tuple[str, int]:
    row = spark.read.parquet(f"{folder}/layout").first()
    return row["kind"], row["indexes"]


def looked_up(spark: SparkSession, keys: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids (binary) of every document whose doc_id is in ``keys``."""
    kind, indexes = layout_of(spark, folder)
    found = records(located(keys.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), folder, indexes), folder, kind)
    starts = spark.read.parquet(f"{folder}/shards").select(F.col("shard").cast("long").alias("shard"), F.col("start").alias("before"))
    size = F.octet_length("ids") / np.dtype(kind).itemsize
    return found.join(starts, "shard").select("doc_id", (F.col("before") + F.col("offset")).alias("start"), size.cast("long").alias("n_tokens"), "ids")


def digests(found: DataFrame, kind: str) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids as 32-bit numbers."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [zlib.crc32(np.frombuffer(ids, kind).astype("<u4")) for ids in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return found.mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")


def filed_and_read(spark: SparkSession, docs: DataFrame, folder: str, tokenizer_path: str) -> DataFrame:
    """Writes all documents and reads each one back by its key."""
    write_token_files(spark, docs, folder, tokenizer_path)
    return digests(looked_up(spark, docs, folder), layout_of(spark, folder)[0])
