"""Ranked lexical search: an impact index in blocks of documents, searched by MaxScore with bounds on term pairs.

The index holds, per block of documents, the postings of the terms that are
asked for. A term's impact in a document is what it adds to the score. For
pairs of frequent terms that queries hold together, every block also keeps the
largest joint impact over the pair's intersection list, so "both terms" is
bounded by what some document really reaches, not by the sum of two maxima that
lie in different documents.

In a block, a query's terms become units (pairs, and single terms). Units with
the smallest bounds are set aside as long as their bounds together stay below
the query's threshold: a document with none but those can't enter. Documents are
taken from the lists of the other units only, and the units set aside are looked
up in order of their bounds, dropping documents that can't reach the threshold
any more. The threshold is the score of the fiftieth document so far; it starts
from a search of some blocks, which is a lower bound for the whole corpus.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from flowgauge.llm.common import text_bytes, values
from flowgauge.session import settle

TOP = 50
#: Documents of a block of the index.
BLOCK_DOCS = 4096
#: Queries are searched in blocks of about so many bytes of text.
QUERY_BYTES = 16 << 20
#: One block in so many gives the first thresholds.
SEED_EVERY = 16
#: Terms in fewer than one document in so many are not paired.
PAIRED_SHARE = 64
_WORD = bytes(c if chr(c).isalnum() or c >= 0x80 else 0x20 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and all other characters from U+0080 on, with A-Z lowered."""
    return text.lower().translate(_WORD).split()


class _Vocabulary(dict):
    def __missing__(self, term: bytes) -> int:
        return -1


@dataclass
class Weights:
    """What the whole corpus says: documents, their terms, and each term's weight."""

    docs: int
    words: int
    weight: np.ndarray

    def impacts(self, term: np.ndarray, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        m = 50 + (50 * length * self.docs) // max(self.words, 1)
        return self.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


@dataclass
class Queries:
    """A block of queries: their distinct terms, and units of one or two terms."""

    ids: list
    vocabulary: _Vocabulary
    of: list[np.ndarray]
    units: list[list[tuple[int, ...]]] = field(default_factory=list)

    def pair_up(self, df: np.ndarray, docs: int) -> None:
        """Terms of a query that are frequent are paired, in order of their frequency, so that queries share pairs."""
        self.units = []
        for q in self.of:
            q = sorted(q.tolist(), key=lambda t: (-df[t], t))
            often = [t for t in q if df[t] * PAIRED_SHARE >= docs]
            pairs = list(zip(often[::2], often[1::2], strict=False))
            self.units.append(pairs + [(t,) for t in q[2 * len(pairs) :]])


def query_blocks(items: DataFrame) -> Iterator[Queries]:
    """The rows of ``items`` (item_id, text) in blocks of bounded size; queries without terms are left out."""
    text = items.select("item_id", text_bytes().alias("text"))
    size = text.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    n = size // QUERY_BYTES + 1
    for i in range(n):
        mine = text.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        out = Queries([], _Vocabulary(), [])
        for row in mine.toLocalIterator():
            found = sorted(set(terms(bytes(row["text"]))))
            if found:
                for t in found:
                    if out.vocabulary[t] < 0:
                        out.vocabulary[t] = len(out.vocabulary)
                out.ids.append(row["item_id"])
                out.of.append(np.array([out.vocabulary[t] for t in found]))
        if out.ids:
            yield out


def index(docs: DataFrame, queries) -> DataFrame:
    """One row per block of documents, with the postings of the queries' terms.

    ``ids`` are the block's documents in rising order (NULL first) and
    ``lengths`` their numbers of terms; ``term`` are the terms met, ``df`` their
    documents in the block, and ``at`` (place in ``ids``) and ``tf`` their
    postings one after the other.
    """
    rows = docs.select("doc_id", text_bytes().alias("text"))
    kind = rows.schema["doc_id"].dataType
    number, whole = T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType())
    schema = T.StructType(
        [
            T.StructField("ids", T.ArrayType(kind)),
            T.StructField("lengths", whole),
            *[T.StructField(n, number) for n in ("term", "df", "at", "tf")],
        ]
    )
    types = to_arrow_schema(schema)

    def block(ids: list[pa.Array], lengths: list[int], parts: list[np.ndarray]) -> pa.RecordBatch:
        ids = pa.concat_arrays(ids)
        order = pc.sort_indices(ids, null_placement="at_start").to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        owner = place[np.repeat(np.arange(len(parts)), [len(p) for p in parts])]
        key = np.concatenate(parts).astype(np.int64) * len(order) + owner
        key, tf = np.unique(key, return_counts=True)
        term, at = np.divmod(key, len(order))
        term, df = np.unique(term, return_counts=True)
        columns = [ids.take(pa.array(order)), np.array(lengths, np.int64)[order], term, df, at, tf]
        return pa.RecordBatch.from_arrays([pa.array([c], type=f.type) for c, f in zip(columns, types)], schema=types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = queries.value.vocabulary.__getitem__
        ids, lengths, parts = [], [], []
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                piece = batch.slice(start, 256)
                ids.append(piece.column(0))
                for text in values(piece.column(1)):
                    words = terms(text)
                    found = np.fromiter(map(number, words), dtype=np.int32, count=len(words))
                    lengths.append(len(words))
                    parts.append(found[found >= 0])
                if len(lengths) >= BLOCK_DOCS:
                    yield block(ids, lengths, parts)
                    ids, lengths, parts = [], [], []
        if lengths:
            yield block(ids, lengths, parts)

    return rows.mapInArrow(run, schema)


def weights(blocks: DataFrame, vocabulary: int) -> tuple[Weights, np.ndarray]:
    """Corpus figures and each term's documents, from a written index."""
    sizes = blocks.select(F.explode("lengths").alias("n")).filter("n > 0")
    total = sizes.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("words")).first()
    docs, words = total["docs"], total["words"] or 0
    each = blocks.select(F.explode(F.arrays_zip("term", "df")).alias("e")).groupBy("e.term").agg(F.sum("e.df").alias("df"))
    df = np.zeros(vocabulary, dtype=np.int64)
    table = each.toArrow()
    df[table.column("term").to_numpy()] = table.column("df").to_numpy()
    weight = [math.floor(1000 * math.log((2 * docs + 2) / (2 * int(d) + 1))) for d in df]
    return Weights(docs, words, np.array(weight, dtype=np.int64)), df


class _Block:
    """One block's lists with impacts, and the joint maxima of its pairs, each computed once."""

    def __init__(self, row: dict, corpus: Weights):
        term, df, at = (np.asarray(row[c], dtype=np.int64) for c in ("term", "df", "at"))
        tf, lengths = np.asarray(row["tf"], dtype=np.int64), np.asarray(row["lengths"], dtype=np.int64)
        self.size = len(lengths)
        impacts = corpus.impacts(np.repeat(term, df), tf, lengths[at])
        ends = np.cumsum(df)
        self.lists = {
            t: (at[e - d : e], impacts[e - d : e]) for t, d, e in zip(term.tolist(), df.tolist(), ends.tolist())
        }
        self.bounds: dict[tuple, int] = {}

    def bound(self, unit: tuple[int, ...]) -> int:
        """The most that a document of this block can get from a unit."""
        found = self.bounds.get(unit)
        if found is None:
            lists = [self.lists[t] for t in unit if t in self.lists]
            found = max((int(x[1].max()) for x in lists), default=0)
            if len(lists) == 2:
                (a, x), (b, y) = lists
                _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
                if len(i):
                    found = max(found, int((x[i] + y[j]).max()))
            self.bounds[unit] = found
        return found

    def search(self, units: list[tuple[int, ...]], threshold: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of all documents with a score of at least ``threshold`` and above 0."""
        threshold = max(threshold, 1)
        bounds = sorted(((b, u) for u in units if (b := self.bound(u))), key=lambda x: (x[0], x[1]))
        aside, rest = 0, 0
        while aside < len(bounds) and rest + bounds[aside][0] < threshold:
            rest += bounds[aside][0]
            aside += 1
        score = np.zeros(self.size, dtype=np.int64)
        for _, unit in bounds[aside:]:
            for t in unit:
                if t in self.lists:
                    at, impact = self.lists[t]
                    score[at] += impact
        # a document without any term of the units not set aside can't reach the threshold
        left = np.flatnonzero(score + rest >= threshold) if aside < len(bounds) else np.empty(0, np.int64)
        for bound, unit in reversed(bounds[:aside]):
            if not len(left):
                break
            for t in unit:
                if t in self.lists:
                    at, impact = self.lists[t]
                    i = np.minimum(np.searchsorted(at, left), len(at) - 1)
                    score[left] += np.where(at[i] == left, impact[i], 0)
            rest -= bound
            left = left[score[left] + rest >= threshold]
        left = left[score[left] >= threshold]
        return left, score[left]


def _best(blocks: DataFrame, queries, corpus, top: int, thresholds: np.ndarray | None) -> DataFrame:
    """(q, doc_id, score) of each task's best documents that reach the thresholds, at most ``top`` per query."""
    kind = blocks.schema["ids"].dataType.elementType
    schema = T.StructType([T.StructField("q", T.IntegerType()), T.StructField("doc_id", kind), T.StructField("score", T.LongType())])
    types = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, known = queries.value, corpus.value
        least = [0] * len(asked.ids) if thresholds is None else thresholds.tolist()
        best: list = [None] * len(asked.ids)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].values for n in ("lengths", "term", "df", "at", "tf")}
                ids = batch.column("ids")[i].values
                block = _Block(row, known)
                for q, units in enumerate(asked.units):
                    at, score = block.search(units, least[q])
                    if not len(at):
                        continue
                    found = ids.take(pa.array(at))
                    if best[q] is not None:
                        found, score = pa.concat_arrays([best[q][0], found]), np.concatenate([best[q][1], score])
                    if len(score) > top:
                        table = pa.table({"id": found, "minus": -score})
                        order = [("minus", "ascending"), ("id", "ascending")]
                        first = pc.sort_indices(table, sort_keys=order, null_placement="at_start")[:top]
                        found, score = found.take(first), score[first.to_numpy()]
                    best[q] = (found, score)
                    if len(score) == top:
                        least[q] = max(least[q], int(score.min()))
        for q, kept in enumerate(best):
            if kept is not None:
                found, score = kept
                columns = [pa.array(np.full(len(score), q, np.int32)), found, pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, schema=types)

    return blocks.mapInArrow(run, schema)


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """Each item's ``top`` documents: item_id, rank, doc_id, score.

    Every document is scored against every item; only scores above 0 are
    given, equal ones by rising doc_id (NULL first). Rows of ``items`` are one
    query each; those without a term (NULL, empty) have no documents. NULL and
    empty texts have no terms and are found by nothing; repeated rows of
    ``docs`` are documents of their own. Other columns are not read.
    """
    spark = docs.sparkSession
    out = None
    for block in query_blocks(items):
        asked = spark.sparkContext.broadcast(block)
        blocks = settle(index(docs, asked))
        corpus, df = weights(blocks, len(block.vocabulary))
        block.pair_up(df, corpus.docs)
        asked, corpus = spark.sparkContext.broadcast(block), spark.sparkContext.broadcast(corpus)

        some = blocks.filter(F.pmod(F.xxhash64("ids"), F.lit(SEED_EVERY)) == 0)
        first = _ranked(_best(some, asked, corpus, top, None), top)
        seeds = np.zeros(len(block.ids), dtype=np.int64)
        for row in first.filter(F.col("rank") == top).select("q", "score").collect():
            seeds[row["q"]] = row["score"]
        ranked = _ranked(_best(blocks, asked, corpus, top, seeds), top)
        names = spark.createDataFrame(list(enumerate(block.ids)), T.StructType([T.StructField("q", T.IntegerType()), items.schema["item_id"]]))
        part = ranked.join(F.broadcast(names), "q").select("item_id", "rank", "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    if out is None:
        schema = [items.schema["item_id"], T.StructField("rank", T.IntegerType()), docs.schema["doc_id"], T.StructField("score", T.LongType())]
        return spark.createDataFrame([], T.StructType(schema))
    return out
