"""Phrase collocations by relational mining (SETM).

The occurrences of frequent phrases of k words are a stored relation, sorted by piece and position. Merging it with
itself at adjacent positions gives the occurrences of k + 1 words; they are counted by group, and a
semi-join with the frequent groups leaves the next relation.

A stored row holds a run of the relation (one slice of text, one language): the phrase that starts at each position,
in order. Places whose phrase is not frequent, and the ends of pieces, are one ``-1``; so two
entries are neighbours in the array exactly if they are in the text, and the merge is a shift by one. Nothing is kept
per word beyond its number.

Groups come from per-slice sums, so a word that is everywhere reaches the shuffle once per slice and task. The
semi-join sends the frequent groups to all tasks only while there are at most ``SMALL_GROUPS`` of them; beyond that the
distinct pairs of each slice are joined with the groups instead, at most one row per slice and pair.

Defined results: a null text has no words; a null lang is ``und``; repeated rows count as often as they stand; an empty table
has no phrases; doc_id and further columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake.llm.common import binary_parts, pieces, stored, whole_text
from meterlake.llm.word_hashes import LOWER

LEAST = 30
LONGEST = 4
TOP = 2000
INSIDE_PERCENT = 80
#: Frequent groups that may be sent to every task (about 24 bytes each, a word's length more for single words).
SMALL_GROUPS = 400_000
SLICE_BYTES = 1 << 20
HELD_PAIRS = 400_000

#: What a byte is: 0 part of a word, 1 white space, 2 the end of a piece.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else [], kind))


def _occurrences(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray, int]:
    """Word numbers by position (-1 between pieces), the words, how often each occurs, and all occurrences."""
    data, bounds = binary_parts(texts)
    data = LOWER[data]
    kind = _KIND[data]
    inside = kind == 0
    begins, finishes = inside.copy(), inside.copy()
    if len(data):
        begins[1:] &= ~inside[:-1]
        finishes[:-1] &= ~inside[1:]
        edges = bounds[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        begins[edges] = inside[edges]
        finishes[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy()
    piece = np.cumsum(kind == 2)[starts] if len(starts) else starts
    piece = piece + np.searchsorted(bounds, starts, "right")
    ended = np.flatnonzero(np.diff(piece)) + 1
    return np.insert(codes, ended, -1), coded.dictionary, np.bincount(codes, minlength=len(coded.dictionary)), len(codes)


#: Runs handed to a task at a time; each is a slice of text.
RUNS_PER_BATCH = 4
TEXTS_PER_BATCH = 256


#: How many rows are decoded from Parquet at once, and travel to Python at once.
_BATCH_SETTINGS = ("spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxRecordsPerBatch")


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """At most so many rows are held together, for what runs inside the block."""
    before = [spark.conf.get(key) for key in _BATCH_SETTINGS]
    for key in _BATCH_SETTINGS:
        spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        for key, value in zip(_BATCH_SETTINGS, before, strict=True):
            spark.conf.set(key, value)


def stored_runs(spark: SparkSession, frame: DataFrame, purpose: str, rows: int = RUNS_PER_BATCH) -> DataFrame:
    """``frame``, made from a relation and written to the shared folder; the rows of a relation are large."""
    with small_batches(spark, rows):
        return stored(spark, frame, purpose)


WORD_RUNS = "run long, lang string, codes array<int>, words array<string>, counts array<int>, n long"


def word_runs(docs: DataFrame) -> DataFrame:
    """The occurrences of all words: one row per slice of text and language."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = TaskContext.get().partitionId() << 40
        for batch in pieces(batches, "text", SLICE_BYTES):
            by_lang = batch.column(0).dictionary_encode()
            rows: list[tuple] = []
            for number, lang in enumerate(by_lang.dictionary.to_pylist()):
                mine = np.flatnonzero(by_lang.indices.to_numpy() == number) if len(by_lang.dictionary) > 1 else None
                codes, words, counts, n = _occurrences(batch.column(1) if mine is None else batch.column(1).take(pa.array(mine)))
                if n:
                    rows.append((run, lang, codes, words, counts, n))
                    run += 1
            if rows:
                words = [r[3].cast(pa.string()) for r in rows]
                offsets = np.zeros(len(rows) + 1, np.int32)
                np.cumsum([len(w) for w in words], out=offsets[1:])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in rows], pa.int64()),
                        pa.array([r[1] for r in rows], pa.string()),
                        _lists([r[2] for r in rows], pa.int32()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.concat_arrays(words)),
                        _lists([r[4] for r in rows], pa.int32()),
                        pa.array([r[5] for r in rows], pa.int64()),
                    ],
                    ["run", "lang", "codes", "words", "counts", "n"],
                )

    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), whole_text().alias("text"))
    return texts.mapInArrow(split, WORD_RUNS)


def _closed_up(ids: np.ndarray) -> np.ndarray:
    """One -1 for each row of them."""
    gone = ids < 0
    again = gone.copy()
    again[1:] &= gone[:-1]
    again[:1] = False
    return ids[~again]


def _pairs(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct neighbours (a, b), how often each occurs, where pairs stand, and which pair stands there."""
    at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
    known, local = np.unique(ids, return_inverse=True)
    keys, which, counts = np.unique(local[at] << 32 | local[at + 1], return_inverse=True, return_counts=True)
    return known[keys >> 32], known[keys & 0xFFFFFFFF], counts, at, which


class Groups:
    """The numbers of frequent pairs."""

    def __init__(self, a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> None:
        self.first, self.second = np.unique(a), np.unique(b)
        keys = np.searchsorted(self.first, a) << 32 | np.searchsorted(self.second, b)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], ids[order]

    @staticmethod
    def _places(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        places = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
        return places, known[places] == wanted

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The number of each pair, -1 where it is not frequent."""
        if not len(self.keys):
            return np.full(len(a), -1, np.int64)
        (x, known_x), (y, known_y) = self._places(self.first, a), self._places(self.second, b)
        place, known = self._places(self.keys, x << 32 | y)
        return np.where(known & known_x & known_y, self.ids[place], -1)


def _extended(ids: np.ndarray, groups: Groups) -> np.ndarray:
    a, b, _, at, which = _pairs(ids)
    out = np.full(max(len(ids) - 1, 0), -1, np.int64)
    out[at] = groups.find(a, b)[which]
    return _closed_up(out)


def _arrays(column: pa.Array) -> Iterator[np.ndarray]:
    for value in column:
        yield value.values.to_numpy(zero_copy_only=False)


def _runs_batch(kept: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r for r, _ in kept], pa.int64()), _lists([i for _, i in kept], pa.int64())], ["run", "ids"])


def _mapped(new_ids: Callable[[pa.RecordBatch], Iterator[np.ndarray]]) -> Callable:
    """A task that writes the next relation; runs without a frequent occurrence go."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [(r, i) for r, i in zip(batch.column(0).to_pylist(), new_ids(batch), strict=True) if len(i) and i.max() >= 0]
            if kept:
                yield _runs_batch(kept)

    return each


RUNS = "run long, ids array<long>"


def numbered(spark: SparkSession, counted: DataFrame, length: int, small: int) -> tuple[DataFrame, int]:
    """Groups with a number of their own among phrases of all lengths, and how many there are.

    Few groups are numbered by descending count, so that the numbers in most pairs are short.
    """
    counted = stored_runs(spark, counted, f"setm-counted-{length}")
    count = counted.count()
    if count <= small:
        place = F.row_number().over(Window.orderBy(F.desc("f"), *[c for c in counted.columns if c != "f"])).cast("long")
    else:
        place = F.monotonically_increasing_id()
    return stored(spark, counted.withColumn("id", place * LONGEST + (length - 1)), f"setm-groups-{length}"), count


def frequent_words(spark: SparkSession, words: DataFrame, least: int, small: int) -> tuple[DataFrame, int]:
    """lang, word, f and id of each frequent word, and their number."""
    each = words.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w"))
    counted = each.groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("f"))
    return numbered(spark, counted.where(F.col("f") >= least), 1, small)


def word_relation(spark: SparkSession, words: DataFrame, frequent: DataFrame, few: bool) -> DataFrame:
    """The occurrences of frequent words."""
    if few:
        sent = spark.sparkContext.broadcast(frequent.select("lang", "word", "id").toArrow().to_pydict())

        def lookup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            numbers: dict[str, dict[str, int]] = {}
            for lang, word, number in zip(*sent.value.values(), strict=True):
                numbers.setdefault(lang, {})[word] = number

            def new_ids(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
                for lang, codes, known in zip(batch.column(1).to_pylist(), _arrays(batch.column(2)), batch.column(3), strict=True):
                    mine = numbers.get(lang, {})
                    table = np.array([mine.get(w, -1) for w in known.values.to_pylist()] + [-1], np.int64)
                    yield _closed_up(table[codes])

            return _mapped(new_ids)(batches)

        return stored_runs(spark, words.select("run", "lang", "codes", "words").mapInArrow(lookup, RUNS), "setm-1")

    each = words.select("run", "lang", F.posexplode("words").alias("code", "word"))
    known = each.join(frequent.select("lang", "word", "id"), ["lang", "word"]).groupBy("run")
    found = known.agg(F.sort_array(F.collect_list(F.struct("code", "id"))).alias("found"))
    joined = words.select("run", "codes").join(found, "run").select("run", "codes", "found.code", "found.id")

    def renumber(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def new_ids(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
            for codes, code, number in zip(*(_arrays(batch.column(i)) for i in (1, 2, 3)), strict=True):
                table = np.full(int(codes.max(initial=-1)) + 2, -1, np.int64)
                table[code] = number
                yield _closed_up(table[codes])

        return _mapped(new_ids)(batches)

    return stored_runs(spark, joined.mapInArrow(renumber, RUNS), "setm-1")


def _summed(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b, n = a[order], b[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    return a[first], b[first], np.add.reduceat(n, first)


def pair_counts(relation: DataFrame) -> DataFrame:
    """a, b and n of neighbours, summed within a task as far as memory allows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            for ids in _arrays(batch.column(1)):
                a, b, n, _, _ = _pairs(ids)
                if len(a):
                    held.append((a, b, n))
                    size += len(a)
                if size > HELD_PAIRS:
                    yield pa.RecordBatch.from_arrays([*map(pa.array, _summed(*map(np.concatenate, zip(*held, strict=True))))], ["a", "b", "n"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([*map(pa.array, _summed(*map(np.concatenate, zip(*held, strict=True))))], ["a", "b", "n"])

    return relation.mapInArrow(count, "a long, b long, n long")


def pairs_by_run(relation: DataFrame) -> DataFrame:
    """run, a and b of neighbours, once per run."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run, ids in zip(batch.column(0).to_pylist(), _arrays(batch.column(1)), strict=True):
                a, b, *_ = _pairs(ids)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), run)), pa.array(a), pa.array(b)], ["run", "a", "b"])

    return relation.mapInArrow(each, "run long, a long, b long")


def frequent_pairs(spark: SparkSession, relation: DataFrame, length: int, least: int, few: bool, small: int) -> tuple[DataFrame, int]:
    """a, b, f and id of each frequent phrase of ``length`` words, and their number; a and b are the phrases without its last, its first word.

    Where the shorter phrases have short numbers (``few``), a pair travels as one number.
    """
    counts = pair_counts(relation)
    if few:
        keyed = counts.select(F.shiftleft("a", 32).bitwiseOR(F.col("b")).alias("key"), "n").groupBy("key").agg(F.sum("n").alias("f"))
        counted = keyed.select(F.shiftright("key", 32).alias("a"), F.col("key").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b"), "f")
    else:
        counted = counts.groupBy("a", "b").agg(F.sum("n").alias("f"))
    return numbered(spark, counted.where(F.col("f") >= least), length, small)


def next_relation(spark: SparkSession, relation: DataFrame, groups: DataFrame, length: int, few: bool) -> DataFrame:
    """The occurrences of the frequent phrases of ``length`` words."""
    if few:
        table = groups.select("a", "b", "id").toArrow()
        sent = spark.sparkContext.broadcast([table.column(i).to_numpy() for i in range(3)])

        def lookup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = Groups(*sent.value)
            return _mapped(lambda batch: (_extended(ids, known) for ids in _arrays(batch.column(1))))(batches)

        return stored_runs(spark, relation.mapInArrow(lookup, RUNS), f"setm-{length}")

    known = pairs_by_run(relation).join(groups.select("a", "b", "id"), ["a", "b"]).groupBy("run")
    found = known.agg(F.collect_list(F.struct("a", "b", "id")).alias("found"))
    joined = relation.join(found, "run").select("run", "ids", "found.a", "found.b", "found.id")

    def renumber(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def new_ids(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
            for ids, *groups in zip(*(_arrays(batch.column(i)) for i in (1, 2, 3, 4)), strict=True):
                yield _extended(ids, Groups(*groups))

        return _mapped(new_ids)(batches)

    return stored_runs(spark, joined.mapInArrow(renumber, RUNS), f"setm-{length}")


def _described(groups: DataFrame, shorter: DataFrame) -> DataFrame:
    """Phrases with what their parts say: words, f of every beginning and every end by length, phrases of two or more words inside."""
    joined = groups.alias("g").join(shorter.alias("x"), F.col("g.a") == F.col("x.id")).join(shorter.alias("y"), F.col("g.b") == F.col("y.id"))
    return joined.select(
        "g.id",
        "x.lang",
        F.array_append("x.words", F.element_at("y.words", -1)).alias("words"),
        "g.f",
        F.array_append("x.heads", F.col("g.f")).alias("heads"),
        F.array_append("y.tails", F.col("g.f")).alias("tails"),
        F.when(F.size("x.words") > 1, F.array_union(F.array_union("x.inside", "y.inside"), F.array("g.a", "g.b")))
        .otherwise(F.expr("CAST(array() AS array<bigint>)"))
        .alias("inside"),
    )


def phrases(spark: SparkSession, docs: DataFrame, least: int = LEAST, small: int = SMALL_GROUPS) -> tuple[DataFrame, DataFrame]:
    """All frequent phrases of two words and more with counts of their parts, and lang and n."""
    words = stored_runs(spark, word_runs(docs), "setm-occurrences", TEXTS_PER_BATCH)
    frequent, count = frequent_words(spark, words, least, small)
    relation = word_relation(spark, words, frequent, count <= small)
    known = frequent.select(
        "id", "lang", F.array("word").alias("words"), "f", F.array("f").alias("heads"), F.array("f").alias("tails"),
        F.expr("CAST(array() AS array<bigint>)").alias("inside"),
    )
    found = []
    for length in range(2, LONGEST + 1):
        groups, count = frequent_pairs(spark, relation, length, least, count <= small, small)
        if length < LONGEST:
            relation = next_relation(spark, relation, groups, length, count <= small)
        known = stored(spark, _described(groups, known), f"setm-phrases-{length}")
        found.append(known)
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every, words.groupBy("lang").agg(F.sum("n").alias("n"))


def collocations(
    spark: SparkSession, docs: DataFrame, least: int = LEAST, top: int = TOP, percent: int = INSIDE_PERCENT, small: int = SMALL_GROUPS
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's best phrases.

    Phrases inside a longer frequent one that occurs nearly as often are left out. Scores are whole
    numbers from exact decimal arithmetic.
    """
    every, totals = phrases(spark, docs, least, small)
    longer = every.select(F.explode("inside").alias("id"), F.col("f").alias("longer")).groupBy("id").agg(F.max("longer").alias("longer"))
    kept = every.join(longer, "id", "left").where(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("f")))
    cut = (
        "array_min(transform(sequence(1, size(words) - 1), k -> named_struct('score', (CAST(2000000 AS DECIMAL(7,0)) * CAST(f AS DECIMAL(20,0))) "
        "div (CAST(heads[k - 1] AS DECIMAL(20,0)) + CAST(tails[size(words) - k - 1] AS DECIMAL(20,0))), "
        "'k', k, 'l', heads[k - 1], 'r', tails[size(words) - k - 1])))"
    )
    scored = kept.select("lang", F.concat_ws(" ", "words").alias("phrase"), F.col("f").alias("a"), F.expr(cut).alias("cut"))
    scored = scored.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
