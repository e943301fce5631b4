"""Phrases whose words go together, mined level by level from relations of occurrences (SETM).

The relation of level m has a row (at, id) for each occurrence of a frequent phrase of m
words, sorted by position ``at``; neighbours in a piece have neighbouring positions, and
between pieces there is a gap. It is cut into runs of whole texts, each packed into one
row: texts are split into words once, and a merge join of a run with itself at the next
position is a comparison of two arrays, with no sort and no shuffle. It gives the occurrences of
phrases one word longer: both parts are frequent and overlap in all words but the outer
two. Grouping counts them, and a semi-join with the frequent groups leaves the next
level's relation.

More frequent groups than are broadcast as arrays are joined as rows: from that level on a
relation is a table of (part, at, id) bucketed by part, the part of the corpus that one task
reads, and sorted by position, and Spark joins, counts and semi-joins it.

Only sub-phrases of frequent phrases are needed for the scores, and these are frequent.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rareflow.llm.common import whole, written

LEAST, LONGEST, REPORTED = 30, 4, 2000
#: A phrase goes if a longer one has at least this share of its occurrences.
SHARE = (80, 100)
#: Frequent groups that are broadcast as arrays (12 bytes each) to packed runs; beyond it occurrences become rows.
PACKED_ROWS = 4_000_000
#: Frequent groups that are broadcast to the semi-join of rows; beyond it both sides are shuffled.
BROADCAST_ROWS = 600_000
#: Runs that go to Python in one batch, and pairs that are counted at once.
RUNS_AT_ONCE, PAIRS_AT_ONCE = 16, 1 << 22
#: Pairs that meet in one range of their hash, and the odd factor of that hash with the one that undoes it, modulo 2**64.
PAIRS_A_RANGE, MIX = 1 << 21, 0x9E3779B97F4A7C15
BACK = pow(MIX, -1, 1 << 64)

#: Buckets for each part, so that few parts share one, and the most that Spark allows.
BUCKETS_A_PART, MOST_BUCKETS = 4, 100_000
BLANKS, MARKS = b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d"
#: Bytes of text that are split into words at a time.
CHUNK_BYTES = 1 << 22
RESULT = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def byte_kinds() -> tuple[np.ndarray, np.ndarray]:
    """(0 word, 1 blank, 2 mark; the byte with A-Z in lower case) by byte.

    All blanks and marks are ASCII, so each byte of a longer UTF-8 sequence is a word's.
    """
    kinds, lower = np.zeros(256, np.uint8), np.arange(256, dtype=np.uint8)
    kinds[list(BLANKS)], kinds[list(MARKS)] = 1, 2
    lower[ord("A") : ord("Z") + 1] += 32
    return kinds, lower


class Words:
    """Splits texts into lower-cased words, counting positions through one part of the corpus.

    A word's position is one more than that of the word before it in the same piece, and
    at least two more than that of any other word.
    """

    def __init__(self) -> None:
        self.kinds, self.lower = byte_kinds()
        self.next = 0

    def split(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """(words, their texts' numbers, their positions)."""
        texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        kind = self.kinds[data]
        inner = kind == 0
        first = inner.copy()
        first[1:] &= ~inner[:-1]
        begins = offsets[:-1][offsets[:-1] < offsets[1:]]
        first[begins] = inner[begins]
        starts = np.flatnonzero(first)
        apart = np.ones(len(starts), np.int64)
        if len(starts):
            # a mark among the bytes from a word to the next one, or the beginning of a text
            apart[1:] += np.maximum.reduceat(kind, starts)[:-1] == 2
            new = np.searchsorted(starts, begins)
            apart[new[new < len(starts)]] = 2
        at = self.next + np.cumsum(apart)
        if len(starts):
            self.next = int(at[-1]) + 1
        # without the bytes between them, each word begins where the one before ends
        last = inner
        last[:-1] &= first[1:] | ~inner[1:]
        sizes = np.flatnonzero(last) + 1 - starts
        ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        packed = self.lower[data[self.kinds[data] == 0]]
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(packed))
        return words, np.searchsorted(offsets, starts, side="right") - 1, at


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``CHUNK_BYTES`` of text, one row at least."""
    sizes = pc.binary_length(batch.column(0)).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes) // CHUNK_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            yield batch.slice(int(a), int(b - a))


def _codes(words: pa.Array, rows: np.ndarray, langs: pa.Array) -> tuple[list, pa.Array, np.ndarray, np.ndarray]:
    """(languages, distinct words, each word's language, each word's number) of one slice."""
    lang = langs.dictionary_encode()
    word = words.dictionary_encode()
    of = lang.indices.to_numpy(zero_copy_only=False)[rows]
    return lang.dictionary.to_pylist(), word.dictionary, of, word.indices.to_numpy(zero_copy_only=False)


#: One row for each language of a slice of texts: its distinct words, how often each occurs, and for every
#: occurrence the word's number and the gap to the occurrence before.
RUNS = "lang string, names array<string>, counts array<long>, codes binary, gaps binary"
#: One row for each run: the occurrences' gaps and ids.
PACKED = "gaps binary, ids binary"


def word_runs(texts: DataFrame) -> DataFrame:
    """``RUNS`` of the texts, which are split into words once.

    Neighbours are in the same run, as a slice holds whole texts. Of a gap only matters whether it is one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = Words()
        for batch in batches:
            for part in _slices(batch):
                words, rows, at = split.split(part.column(0))
                langs, names, of, word = _codes(words, rows, part.column(1))
                for i, lang in enumerate(langs):
                    mine = np.flatnonzero(of == i)
                    if not len(mine):
                        continue
                    counts = np.bincount(word[mine], minlength=len(names))
                    seen = np.flatnonzero(counts)
                    code = np.zeros(len(names), np.int32)
                    code[seen] = np.arange(len(seen), dtype=np.int32)
                    whole_list = pa.array([0, len(seen)], pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang], pa.string()),
                            pa.ListArray.from_arrays(whole_list, names.take(pa.array(seen)).cast(pa.string())),
                            pa.ListArray.from_arrays(whole_list, pa.array(counts[seen], pa.int64())),
                            pa.array([code[word[mine]].tobytes()], pa.binary()),
                            pa.array([_gaps(at[mine])], pa.binary()),
                        ],
                        ["lang", "names", "counts", "codes", "gaps"],
                    )

    return texts.mapInArrow(run, RUNS)


def _gaps(at: np.ndarray) -> bytes:
    """From each position back to the one before, in a byte: one, or two for anything more."""
    return np.minimum(np.diff(at, prepend=at[:1] - 2), 2).astype(np.uint8).tobytes()


def _numbers(values: pa.Array, i: int, kind: type) -> np.ndarray:
    return np.frombuffer(values[i].as_buffer(), kind)


def count_words(runs: DataFrame) -> DataFrame:
    """(lang, phrase, n): occurrences of every word, counted in each run and task before they are shuffled."""
    words = runs.select("lang", F.inline(F.arrays_zip(F.col("names").alias("phrase"), F.col("counts").alias("n"))))
    return words.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _packed(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """A row for each (positions, ids)."""
    gaps = pa.array([_gaps(at) for at, _ in found], pa.binary())
    return pa.RecordBatch.from_arrays([gaps, pa.array([i.astype(np.int32).tobytes() for _, i in found], pa.binary())], ["gaps", "ids"])


def word_places(runs: DataFrame, known: Broadcast) -> DataFrame:
    """``PACKED`` occurrences of the broadcast words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = known.value
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for lang in set(langs) & set(ids):
                table, numbers = ids[lang]
                part = batch.take(pa.array(np.flatnonzero(langs == lang)))
                names = part.column(1)
                place = pc.index_in(names.flatten().cast(table.type), value_set=table).fill_null(-1).to_numpy(zero_copy_only=False)
                number = np.where(place >= 0, numbers[place], -1) if len(numbers) else np.full(len(place), -1)
                starts = np.concatenate(([0], np.cumsum(names.value_lengths().to_numpy())))
                found = []
                for i in range(part.num_rows):
                    word = number[starts[i] : starts[i + 1]][_numbers(part.column(2), i, np.int32)]
                    kept = np.flatnonzero(word >= 0)
                    if len(kept):
                        found.append((np.cumsum(_numbers(part.column(3), i, np.uint8), dtype=np.int64)[kept], word[kept]))
                if found:
                    yield _packed(found)

    return runs.select("lang", "names", "codes", "gaps").mapInArrow(run, PACKED)


def word_rows(runs: DataFrame) -> DataFrame:
    """(part, at, lang, phrase) of every occurrence, for vocabularies too large to broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, last = TaskContext.get().partitionId(), 0
        for batch in batches:
            for i in range(batch.num_rows):
                words = batch.column(1)[i].values.take(pa.array(_numbers(batch.column(2), i, np.int32)))
                at = last + np.cumsum(_numbers(batch.column(3), i, np.uint8), dtype=np.int64)
                last = int(at[-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), number, np.int32)), pa.array(at), pa.array([batch.column(0)[i].as_py()] * len(at), pa.string()), words],
                    ["part", "at", "lang", "phrase"],
                )

    return runs.select("lang", "names", "codes", "gaps").mapInArrow(run, "part int, at long, lang string, phrase string")


def _pairs(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
    """The merge join of a run with itself at the next position: (positions, pairs of ids)."""
    at, ids = np.cumsum(_numbers(batch.column(0), i, np.uint8), dtype=np.int64), _numbers(batch.column(1), i, np.int32).astype(np.int64)
    first = np.flatnonzero(at[1:] - at[:-1] == 1)
    return at[first], (ids[first] << 32) | ids[first + 1]


def count_pairs(packed: DataFrame, occurrences: int, least: int) -> DataFrame:
    """(pair, n) of the pairs that occur ``least`` times, grouped by ranges of a hash that can be turned back.

    A task sorts ``PAIRS_AT_ONCE`` hashes at a time and sends each range's as one row. ``occurrences`` are all
    that may be there: at most ``PAIRS_A_RANGE`` meet in a range on average.
    """
    bits = max(0, min(16, math.ceil(math.log2(max(1, occurrences) / PAIRS_A_RANGE))))
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(0, np.uint64)

    def ranges(pairs: list[np.ndarray]) -> pa.RecordBatch:
        hashes, counts = np.unique(np.concatenate(pairs).view(np.uint64) * np.uint64(MIX), return_counts=True)
        cuts = np.concatenate(([0], np.searchsorted(hashes, edges), [len(hashes)]))
        some = np.flatnonzero(np.diff(cuts))
        counts = counts.astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(some.astype(np.int32)),
                pa.array([hashes[cuts[i] : cuts[i + 1]].tobytes() for i in some], pa.binary()),
                pa.array([counts[cuts[i] : cuts[i + 1]].tobytes() for i in some], pa.binary()),
            ],
            ["range", "hashes", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                waiting.append(_pairs(batch, i)[1])
                size += len(waiting[-1])
                if size >= PAIRS_AT_ONCE:
                    yield ranges(waiting)
                    waiting, size = [], 0
        if size:
            yield ranges(waiting)

    def total(rows: pa.Table) -> pa.Table:
        hashes = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in rows["hashes"]])
        counts = np.concatenate([np.frombuffer(x.as_buffer(), np.int32) for x in rows["counts"]])
        order = np.argsort(hashes)
        hashes = hashes[order]
        first = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
        n = np.add.reduceat(counts[order].astype(np.int64), first)
        often = np.flatnonzero(n >= least)
        pairs = (hashes[first[often]] * np.uint64(BACK)).view(np.int64)
        return pa.table({"pair": pa.array(pairs), "n": pa.array(n[often])})

    parts = packed.mapInArrow(run, "range int, hashes binary, counts binary")
    return parts.groupBy("range").applyInArrow(total, "pair long, n long")


def frequent_pairs(packed: DataFrame, known: Broadcast) -> DataFrame:
    """``PACKED`` occurrences of the broadcast (pairs in order, their ids): the semi-join where the runs lie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, numbers = known.value
        for batch in batches:
            found = []
            for i in range(batch.num_rows):
                at, pairs = _pairs(batch, i)
                place = np.minimum(np.searchsorted(table, pairs), len(table) - 1)
                kept = np.flatnonzero(table[place] == pairs)
                if len(kept):
                    found.append((at[kept], numbers[place[kept]]))
            if found:
                yield _packed(found)

    return packed.mapInArrow(run, PACKED)


def pair_rows(packed: DataFrame) -> DataFrame:
    """(part, at, pair) of the runs, for more frequent pairs than are broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            for i in range(batch.num_rows):
                at, pairs = _pairs(batch, i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), number, np.int32)), pa.array(start + at), pa.array(pairs)], ["part", "at", "pair"]
                )
                start += 2 * len(batch.column(0)[i].as_buffer()) + 2  # no gap is more than two

    return packed.mapInArrow(run, "part int, at long, pair long")


def with_dense_ids(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` as a written table with an id from 0 on; two ids make one key of 64 bits."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))
    stored = written(rows.withColumns({"_of": F.spark_partition_id(), "_place": place}), label)
    found = sorted(tuple(r) for r in stored.groupBy("_of").count().collect())
    firsts, total = [], 0
    for of, count in found:
        firsts.append((of, total))
        total += count
    if total >= 2**31:
        raise ValueError("more than 2**31 frequent phrases of one length")
    starts = stored.sparkSession.createDataFrame(firsts, "_of int, _first long")
    return stored.join(F.broadcast(starts), "_of").withColumn("id", F.col("_first") + F.col("_place")).drop("_of", "_place", "_first")


class Relations:
    """The tables of one run, in ``buckets`` buckets of parts; they are dropped in the end."""

    #: A table bucketed by part alone is joined by part and position where it lies, and
    #: texts go to Python in small batches.
    SETTINGS = {
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    }

    def __init__(self, spark: SparkSession):
        self.spark, self.buckets, self.run, self.names = spark, 1, uuid.uuid4().hex, []
        self.before = {k: spark.conf.get(k, None) for k in self.SETTINGS}

    def __enter__(self) -> Relations:
        for k, v in self.SETTINGS.items():
            self.spark.conf.set(k, v)
        return self

    def __exit__(self, *_) -> None:
        for k, v in self.before.items():
            self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def batches(self, rows: int) -> None:
        """From now on so many rows go to Python at a time."""
        self.spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))

    def deal(self, parts: DataFrame) -> None:
        """Buckets for the parts that this table is read in."""
        found = parts.select(F.spark_partition_id().alias("part")).distinct().count()
        self.buckets = min(MOST_BUCKETS, BUCKETS_A_PART * max(1, found))

    def keep(self, rows: DataFrame, level: int) -> DataFrame:
        name = f"occurrences_{level}_{self.run}"
        self.names.append(name)
        rows.write.bucketBy(self.buckets, "part").sortBy("at").format("parquet").saveAsTable(name)
        return self.spark.table(name)


def adjacent(rows: DataFrame) -> DataFrame:
    """(part, at, pair): phrases a and b, b one position after a; a merge join without a shuffle."""
    after = rows.select("part", (F.col("at") - 1).alias("at"), F.col("id").alias("b"))
    both = rows.hint("merge").join(after, ["at", "part"])
    return both.select("part", "at", F.shiftleft("id", 32).bitwiseOR(F.col("b")).alias("pair"))


def semi_join(rows: DataFrame, groups: DataFrame, keys: list[str], many: bool, buckets: int) -> DataFrame:
    """(part, at, id) of the rows whose key is among ``groups``.

    A checked number of groups is broadcast and the rows stay where they are. More groups
    are joined by their key, where Spark splits a hot key of the left side, and the rows
    are dealt by part again.
    """
    if many:
        return rows.hint("merge").join(groups, keys).select("part", "at", "id").repartition(buckets, "part")
    return rows.join(F.broadcast(groups), keys).select("part", "at", "id")


def frequent_words(vocabulary: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, last, n, before, after, a, b) of words with ``least`` occurrences."""
    none = F.array().cast("array<long>")
    return vocabulary.where(F.col("n") >= least).select(
        "lang", "phrase", F.col("phrase").alias("last"), "n", none.alias("before"), none.alias("after"),
        F.lit(None).cast("long").alias("a"), F.lit(None).cast("long").alias("b"),
    )


def longer_phrases(counted: DataFrame, level: DataFrame) -> DataFrame:
    """The next level from the frequent pairs (pair, n) of overlapping phrases of this one.

    ``before`` has the counts of the phrase's proper beginnings, shortest first, and
    ``after`` those of its proper endings, longest first: one of each for every cut.
    """
    left = level.select(
        F.col("id").alias("a"), "lang", F.col("phrase").alias("_head"), F.concat("before", F.array("n")).alias("before")
    )
    right = level.select(
        F.col("id").alias("b"), F.col("last").alias("last"), F.concat(F.array("n"), F.col("after")).alias("after")
    )
    parts = counted.select("n", F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(F.lit(2**32 - 1)).alias("b"))
    rows = parts.join(left, "a").join(right, "b")
    return rows.select("lang", F.concat_ws(" ", "_head", "last").alias("phrase"), "last", "n", "before", "after", "a", "b")


def score_cuts(phrases: DataFrame) -> DataFrame:
    """Adds l, r and score of the lowest-scoring cut, ties to the first one, in exact decimals."""
    part = F.expr(
        "array_min(transform(before, (l, i) -> struct("
        "cast(2000000 * cast(n as decimal(28, 0)) as decimal(38, 0)) div (cast(l as decimal(28, 0)) + cast(after[i] as decimal(28, 0))) as score, "
        "i as cut, l as l, after[i] as r)))"
    )
    return phrases.withColumn("_part", part).select(
        "lang", "phrase", "id", F.col("n").alias("a"), F.col("_part.l").alias("l"), F.col("_part.r").alias("r"),
        F.col("_part.score").cast("long").alias("score"),
    )


def without_covered(level: DataFrame, longer: DataFrame | None) -> DataFrame:
    """``level`` without the phrases that a longer candidate nearly always contains.

    A phrase one word longer has at least the occurrences of any still longer one around
    it, so that the next level decides.
    """
    if longer is None:
        return level
    parts = longer.select("n", F.explode(F.array_distinct(F.array("a", "b"))).alias("id"))
    most = parts.groupBy("id").agg(F.max("n").alias("most"))
    exact = "decimal(38, 0)"
    rows = level.join(most, "id", "left")
    covered = F.col("most").cast(exact) * SHARE[1] >= F.col("n").cast(exact) * SHARE[0]
    return rows.where(~F.coalesce(covered, F.lit(False))).drop("most")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST,
    reported: int = REPORTED, broadcast_rows: int = BROADCAST_ROWS, packed_rows: int = PACKED_ROWS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``reported`` phrases.

    Every occurrence in every whole text counts, repeated rows as often as they come.
    Null texts are empty, a null language is ``und``. Ties in score and count go to the
    phrase that comes first in byte order. Empty tables and tables without a frequent
    pair give no rows. Extra columns are not read.
    """
    spark = docs.sparkSession
    texts = docs.select(whole(docs[text_col]).alias("text"), F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"))
    with Relations(spark) as relations:
        totals, levels = _mined(docs, texts, relations, least, longest, broadcast_rows, packed_rows)
    scored = None
    for level, longer in zip(levels[1:], [*levels[2:], None]):
        some = score_cuts(without_covered(level, longer))
        scored = some if scored is None else scored.unionByName(some)
    if scored is None:
        return spark.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(first).cast("long")).where(F.col("rank") <= reported)
    return ranked.join(totals, "lang").withColumnRenamed("total", "n").select(*RESULT)


def _mined(
    docs: DataFrame, texts: DataFrame, relations: Relations, least: int, longest: int, broadcast_rows: int, packed_rows: int
) -> tuple[DataFrame, list[DataFrame]]:
    """(words of each language, frequent phrases of one word, two words and so on)."""
    spark = docs.sparkSession
    runs = written(word_runs(texts), "words-in-runs")
    relations.batches(RUNS_AT_ONCE)
    vocabulary = written(count_words(runs), "words-counted")
    totals = vocabulary.groupBy("lang").agg(F.sum("n").alias("total"))
    levels = [with_dense_ids(frequent_words(vocabulary, least), "phrases-1")]
    occurrences = totals.agg(F.sum("total")).first()[0] or 0
    packed, rows = None, None
    if levels[0].count() <= packed_rows:
        table = levels[0].select("lang", "phrase", "id").toArrow()
        known = {}
        for lang in pc.unique(table["lang"]).to_pylist():
            mine = table.filter(pc.equal(table["lang"], lang))
            known[lang] = (mine["phrase"].combine_chunks().cast(pa.large_string()), mine["id"].to_numpy())
        packed = written(word_places(runs, spark.sparkContext.broadcast(known)), "occurrences-1")
    else:
        relations.deal(runs)
        found = semi_join(word_rows(runs), levels[0].select("lang", "phrase", "id"), ["lang", "phrase"], True, relations.buckets)
        rows = relations.keep(found, 1)
    for m in range(2, longest + 1):
        pairs = adjacent(rows) if packed is None else None
        counted = count_pairs(packed, occurrences, least) if pairs is None else pairs.groupBy("pair").agg(F.count("*").alias("n"))
        level = with_dense_ids(longer_phrases(counted.where(F.col("n") >= least), levels[-1]), f"phrases-{m}")
        groups = level.count()
        if not groups:
            break
        levels.append(level)
        if m == longest:
            break
        keys = level.select(F.shiftleft("a", 32).bitwiseOR(F.col("b")).alias("pair"), "id")
        if packed is not None and groups <= packed_rows:
            table = keys.toArrow()
            pair = table["pair"].to_numpy()
            order = np.argsort(pair)
            known = (pair[order], table["id"].to_numpy()[order].astype(np.int32))
            packed = written(frequent_pairs(packed, spark.sparkContext.broadcast(known)), f"occurrences-{m}")
            continue
        if packed is not None:
            relations.deal(packed)
            pairs, packed = pair_rows(packed), None
        rows = relations.keep(semi_join(pairs, keys, ["pair"], groups > broadcast_rows, relations.buckets), m)
    return totals, levels
