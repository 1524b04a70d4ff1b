"""Phrase collocations by Toivonen's mining: a sample proposes, full passes count exactly what it may have missed too.

A sample of the texts' pieces gives the phrases that are frequent in it at a
lowered threshold. They are only a proposal, and go into a bit table of bounded
size. The full pass then counts every phrase whose first and last ``k - 1``
words were proposed: the proposed phrases and their negative border. A border
phrase that turns out frequent is a failure of the sample. A frequent phrase that
this pass did not count has a shortest part that was not proposed; all parts of
that one were, so it was counted and is a failure. Another pass therefore counts
all phrases that hold a failure, whatever else they hold, and with it the mining
is closed. Counts are exact whatever the sample was: a poor or a full bit table
costs more counted phrases, never a phrase.

The counts of these passes are by a 64-bit hash of the phrase and its last word's,
from which the hash of the words before that one follows: the hash can be undone.
So a frequent phrase is spelled by joining the frequent phrases with each other, word
by word. The full pass gives single words with their text, each chunk all of its words:
as many rows as it would take without the text, and no further pass for it. Two words of
one hash, or phrases of one hash with different last words, would show there; then a
pass counts all phrases by their text instead.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.llm.bloom import BitTable, bit_table
from flowgauge.llm.common import text_bytes, values
from flowgauge.llm.joins import counted_join
from flowgauge.llm.words import WordHashes, followed_by, head_of, mix
from flowgauge.session import settle

MAX_WORDS = 5
LEAST = 100
TOP = 2000
#: One piece in so many is in the sample; there a phrase is proposed at ``SLACK`` times its share of ``LEAST``.
SAMPLE_EVERY = 20
SLACK = 0.6
NO_LANG = "und"
#: Words that a task gathers before it counts.
_TOKENS = 1 << 20
_SALTS = 64
_BREAK = b"\xff"  # no byte of UTF-8
_TO_BREAK = bytes.maketrans(b".,;:!?\x0a\x0b\x0c\x0d", _BREAK * 10)


def tokens(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text with A-Z lowered, and a break between pieces."""
    return text.lower().translate(_TO_BREAK).replace(_BREAK, b" " + _BREAK + b" ").split()


class _Numbers(dict):
    """word -> number in order of appearance; 0 is the break."""

    def __init__(self):
        self[_BREAK] = 0
        self.parts, self.size = [], 0

    def add(self, words: list[bytes]) -> None:
        words.append(_BREAK)
        self.parts.append(np.fromiter(map(self.__getitem__, words), dtype=np.int32, count=len(words)))
        self.size += len(words)

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _lang_seed(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode(), 1))


def _rolling(first: np.ndarray, words: np.ndarray, is_word: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, valid, hashes) of the phrases of ``k`` words that begin at each place of a chunk."""
    valid, hashes = is_word, first
    yield 1, valid, hashes
    for k in range(2, MAX_WORDS + 1):
        valid = valid[:-1] & is_word[k - 1 :]
        hashes = followed_by(hashes[:-1], words[k - 1 :])
        yield k, valid, hashes


def _at(mask: np.ndarray, table: BitTable, hashes: np.ndarray) -> np.ndarray:
    """The places of ``mask`` whose hash may be in the table."""
    out = np.zeros(len(mask), dtype=bool)
    places = np.flatnonzero(mask)
    out[places] = table.may_hold(hashes[places])
    return out


def _counted(hashes: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different pairs of phrase hash and last word's, and how often each occurs (in several parts, if hashes are equal)."""
    order = np.argsort(hashes)
    hashes, last = hashes[order], last[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (last[1:] != last[:-1])
    at = np.flatnonzero(new)
    return hashes[at], last[at], np.diff(at, append=len(hashes))


def _proposed_border(first, words, is_word, proposal: BitTable | None, shortest: int = 1) -> Iterator[tuple]:
    """(k, hashes, last words, counts) of a chunk's phrases whose shorter parts are all proposed (None proposes everything)."""
    is_open, before = None, None
    for k, valid, hashes in _rolling(first, words, is_word):
        if k == 1:
            is_open = valid
        else:
            held = is_open if proposal is None else _at(is_open, proposal, before)
            is_open = held[:-1] & held[1:]  # so all words are in one piece
        if not is_open.any():
            return
        if k >= shortest:
            yield k, *_counted(hashes[is_open], words[k - 1 :][is_open])
        before = hashes


def _around(first, words, is_word, failures: BitTable) -> Iterator[tuple]:
    """(k, hashes, last words, counts) of a chunk's phrases that hold a failure as a shorter part."""
    holds = None
    for k, valid, hashes in _rolling(first, words, is_word):
        longer = np.zeros(len(valid), dtype=bool) if holds is None else (holds[:-1] | holds[1:]) & valid
        if longer.any():
            yield k, *_counted(hashes[longer], words[k - 1 :][longer])
        holds = longer | _at(valid, failures, hashes)


def _spelled(chunk, first, words, is_word, wanted: BitTable) -> Iterator[tuple]:
    """(k, word numbers, counts) of the phrases of a chunk whose hash, and those of their parts, may be in the table."""
    found = None
    for k, valid, hashes in _rolling(first, words, is_word):
        found = _at(valid if found is None else found[:-1] & found[1:], wanted, hashes)
        places = np.flatnonzero(found)
        if not len(places):
            return
        if k == 1:
            counts = np.bincount(chunk[places])
            numbers = np.flatnonzero(counts)
            yield 1, numbers[:, None], counts[numbers]
            continue
        _, at, inverse, counts = np.unique(hashes[places], return_index=True, return_inverse=True, return_counts=True)
        first_at = places[at]
        if any((chunk[places + i] != chunk[first_at + i][inverse]).any() for i in range(k)):  # one hash, two phrases
            phrases, counts = np.unique(chunk[places[:, None] + np.arange(k)], axis=0, return_counts=True)
            yield k, phrases, counts
        else:
            yield k, chunk[first_at[:, None] + np.arange(k)], counts


def _chunks(batches: Iterator[pa.RecordBatch], cut: Callable | None = None) -> Iterator[tuple]:
    """(lang, words, word numbers, and per place: first hash, word hash, is a word) of about a million words each."""
    cache, gathered = WordHashes(), {}

    def done(lang: str, numbers: _Numbers) -> tuple:
        chunk, words = np.concatenate(numbers.parts), list(numbers)
        own = cache.of(words)
        return lang, words, chunk, mix(own ^ _lang_seed(lang))[chunk], own[chunk], chunk > 0

    for batch in batches:
        marks = batch.column(2).to_pylist() if cut else None
        for i, (lang, text) in enumerate(zip(batch.column(0).to_pylist(), values(batch.column(1)))):
            if lang not in gathered:
                gathered[lang] = _Numbers()
            gathered[lang].add(tokens(cut(text, marks[i]) if cut else text))
            if sum(g.size for g in gathered.values()) > _TOKENS:
                largest = max(gathered, key=lambda x: gathered[x].size)
                yield done(largest, gathered.pop(largest))
    for lang, numbers in gathered.items():
        yield done(lang, numbers)


def _texts(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang"), F.lit(NO_LANG)).alias("lang"), text_bytes().alias("text"), *more)


def _hash_counts(rows: DataFrame, table, of_chunk: Callable, cut: Callable | None = None, spell: bool = False) -> DataFrame:
    """(k, h, n, w, other) of the phrases that ``of_chunk`` counts with the broadcast table, summed over the corpus.

    ``w`` is the hash of the last word, and ``other`` a different one if phrases of one hash don't end in one word.
    With ``spell`` all words are counted by lang and text too (``k = 1``, and ``k = 0`` with a language's number of
    words); both are NULL for the phrases of ``of_chunk``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, chunk, first, own, is_word in _chunks(batches, cut):
            if spell:
                yield _words_of_chunk(lang, words, chunk, first, own)
            for k, hashes, last, counts in of_chunk(first, own, is_word, table and table.value):
                numbers = [hashes.view(np.int64), last.view(np.int64), counts]
                columns = [pa.array(np.full(len(hashes), k, np.int32)), *map(pa.array, numbers)]
                if spell:
                    columns += [pa.nulls(len(hashes), pa.string()), pa.nulls(len(hashes), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema, by = "k int, h bigint, w bigint, n bigint", ["k", "h"]
    if spell:
        schema, by = f"{schema}, lang string, word binary", [*by, "lang", "word"]
    names = [field.split()[0] for field in schema.split(", ")]
    counted = rows.mapInArrow(run, schema)
    if spell:
        counted = counted.withColumn("word", F.col("word").cast("string"))
    ends = (F.min("w").alias("w"), F.max("w").alias("other"))
    return counted.groupBy(*by).agg(F.sum("n").alias("n"), *ends)


def _words_of_chunk(lang: str, words: list[bytes], chunk, first, own) -> pa.RecordBatch:
    """(k, h, w, n, lang, word) of a chunk's different words, and of all together (``k = 0``)."""
    numbers = np.zeros((3, len(words)), np.int64)  # 0 is the break, and stands for all words
    numbers[0, chunk], numbers[1, chunk] = first.view(np.int64), own.view(np.int64)
    numbers[2] = np.bincount(chunk, minlength=len(words))
    numbers[:, 0] = 0, 0, numbers[2, 1:].sum()
    k = np.ones(len(words), np.int32)
    k[0] = 0
    texts = pa.array([None, *words[1:]], pa.binary())
    columns = [pa.array(k), *map(pa.array, numbers), pa.repeat(pa.scalar(lang, pa.string()), len(words)), texts]
    return pa.RecordBatch.from_arrays(columns, names=["k", "h", "w", "n", "lang", "word"])


def _with_heads(frequent: DataFrame) -> DataFrame:
    """Frequent phrases of two words or more, with the hash ``head`` of the phrase without its last word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, w = (batch.column(i).to_numpy().view(np.uint64) for i in (1, 2))
            yield batch.append_column("head", pa.array(head_of(h, w).view(np.int64)))

    longer = frequent.filter("k > 1").select("k", "h", "w", "n")
    return longer.mapInArrow(run, "k int, h bigint, w bigint, n bigint, head bigint")


def _repeated(rows: DataFrame, *key: str) -> bool:
    """Whether a key is held by more than one row."""
    return not rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()


def _spelled_counts(words: DataFrame, frequent: DataFrame) -> DataFrame | None:
    """(lang, k, phrase, n) of the frequent phrases, put together of frequent ``words``; None if two share a hash."""
    texts = settle(words.select("w", "word").distinct())
    if not frequent.filter("w <> other OR texts > 1").isEmpty() or _repeated(texts, "w"):
        return None
    longer = settle(_with_heads(frequent))
    uses = longer.groupBy("w").agg(F.count(F.lit(1)).alias("uses"))
    longer = settle(counted_join(longer, settle(texts.join(uses.hint("merge"), "w")), ["w"], "uses"))
    level = words.select("lang", F.lit(1).alias("k"), "h", F.col("word").alias("phrase"), "n")
    found = level
    for k in range(2, MAX_WORDS + 1):
        heads = level.select("lang", F.col("h").alias("head"), F.col("phrase").alias("start"))
        grown = longer.filter(F.col("k") == k).join(heads.hint("merge"), "head")
        phrase = F.concat_ws(" ", "start", "word").alias("phrase")
        level = settle(grown.select("lang", "k", "h", phrase, "n"))
        found = found.unionByName(level)
    return found.drop("h") if found.count() == frequent.count() else None


def _text_counts(rows: DataFrame, wanted) -> DataFrame:
    """(lang, k, phrase, n) of the phrases whose hash may be wanted; ``k = 0`` counts all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "k", "phrase", "n"]
        for lang, words, chunk, first, own, is_word in _chunks(batches):
            total = [pa.array([lang]), pa.array([0], pa.int32()), pa.array([""]), pa.array([int(is_word.sum())])]
            yield pa.RecordBatch.from_arrays(total, names=names)
            for k, phrases, counts in _spelled(chunk, first, own, is_word, wanted.value):
                for start in range(0, len(phrases), 1 << 15):
                    part = phrases[start : start + (1 << 15)]
                    found = [b" ".join([words[w] for w in p]) for p in part.tolist()]
                    columns = [
                        pa.array([lang] * len(found)),
                        pa.array(np.full(len(found), k, np.int32)),
                        pa.array(found, pa.binary()).cast(pa.string()),
                        pa.array(counts[start : start + len(found)]),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    counted = rows.mapInArrow(run, "lang string, k int, phrase string, n bigint")
    return counted.groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"))


def _proposed(docs: DataFrame, least: int, every: int) -> BitTable:
    """The bit table of the phrases that are frequent in the sample: one piece in ``every`` of each document."""

    def cut(text: bytes, start: int) -> bytes:
        return _BREAK.join(text.translate(_TO_BREAK).split(_BREAK)[start::every])

    rows = _texts(docs, F.pmod(F.xxhash64("doc_id", "text"), F.lit(every)).alias("start"))
    found = _hash_counts(rows, None, _proposed_border, cut).filter(F.col("n") >= max(2, int(SLACK * least / every)))
    return bit_table(settle(found.select("h")))


def _missing(frequent: DataFrame, proposal) -> DataFrame:
    """Hashes ``h`` of the frequent phrases that the proposal doesn't hold and that longer ones may be built on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(~proposal.value.may_hold(batch.column(0).to_numpy().view(np.uint64))))

    return frequent.filter(F.col("k") < MAX_WORDS).select("h").mapInArrow(run, "h bigint")


def frequent_phrases(docs: DataFrame, least: int = LEAST, sample_every: int = SAMPLE_EVERY) -> DataFrame:
    """Exact counts (lang, k, phrase, n) of all phrases of 1 to 5 words with ``n >= least``, and ``k = 0`` with all words."""
    spark = docs.sparkSession

    def shared(table: BitTable):
        return spark.sparkContext.broadcast(table)

    proposal = shared(_proposed(docs, least, sample_every))
    counted = _hash_counts(_texts(docs), proposal, partial(_proposed_border, shortest=2), None, True)
    counted = settle(counted.filter((F.col("k") < 2) | (F.col("n") >= least)))
    frequent = settle(_frequent_hashes(counted, least))
    failures = settle(_missing(frequent, proposal))
    if not failures.isEmpty():
        around = _hash_counts(_texts(docs), shared(bit_table(failures)), _around).withColumn("texts", F.lit(1))
        found = frequent.unionByName(around.filter(F.col("n") >= least))
        frequent = settle(found.dropDuplicates(["k", "h"]))  # both passes count whole phrases
    words = counted.filter((F.col("k") == 1) & (F.col("n") >= least))
    spelled = _spelled_counts(words, frequent)
    if spelled is not None:
        total = counted.filter("k = 0").select("lang", "k", F.lit("").alias("phrase"), "n")
        return total.unionByName(spelled)
    by_text = _text_counts(_texts(docs), shared(bit_table(frequent.select("h"))))
    return by_text.filter((F.col("k") == 0) | (F.col("n") >= least))


def _frequent_hashes(counted: DataFrame, least: int) -> DataFrame:
    """(k, h, n, w, other, texts) of what is frequent by hash; ``texts`` is above 1 if a hash counts several words."""
    ends = (F.min("w").alias("w"), F.max("w").alias("other"))
    texts = F.count(F.lit(1)).cast("int").alias("texts")
    words = counted.filter("k = 1").groupBy("k", "h").agg(F.sum("n").alias("n"), *ends, texts)
    phrases = counted.filter("k > 1").select("k", "h", "n", "w", "other", F.lit(1).alias("texts"))
    return words.filter(F.col("n") >= least).unionByName(phrases)


def _part(first: Column, n: Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, n), " ")


def collocations(
    docs: DataFrame, least: int = LEAST, top: int = TOP, sample_every: int = SAMPLE_EVERY
) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    Texts are lowered (A-Z), split into pieces at ``.,;:!?`` and line ends, and
    pieces into words at blanks and tabs. All counts are per language (NULL:
    ``und``) and include overlaps. A phrase of 2 to 5 words that occurs ``a >=
    least`` times is scored by its weakest cut, ``floor(1000 * a * n / (l *
    r))``, and left out if a phrase of one word more that holds it occurs as
    often. NULL and empty texts have no words; repeated rows count each time;
    other columns of ``docs`` but doc_id (for the sample) are not read.
    """
    found = settle(frequent_phrases(docs, least, sample_every))
    words = found.filter("k = 0").select("lang", F.col("n").alias("words"))
    phrases = found.filter("k > 0").select("lang", "phrase", "k", F.col("n").alias("a"))

    longer = phrases.filter("k > 2")
    ends = F.explode(F.array(_part(F.lit(1), F.col("k") - 1), _part(F.lit(2), F.col("k") - 1)))
    within = longer.select("lang", ends.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("covered"))
    own = phrases.filter("k > 1").join(within.hint("merge"), ["lang", "phrase"], "left")
    own = own.filter("covered IS NULL OR covered < a").select("lang", "phrase", "k", "a")

    cuts = own.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = settle(
        cuts.select(
            "lang", "phrase", "a", "cut",
            _part(F.lit(1), F.col("cut")).alias("head"),
            _part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("tail"),
        )
    )
    for side, name in (("head", "l"), ("tail", "r")):
        uses = cuts.groupBy("lang", side).agg(F.count(F.lit(1)).alias("uses"))
        known = phrases.select("lang", F.col("phrase").alias(side), F.col("a").alias(name))
        known = settle(known.join(uses.hint("merge"), ["lang", side]))
        cuts = settle(counted_join(cuts, known, ["lang", side], "uses").drop("uses", side))

    def exact(name: str) -> Column:
        return F.col(name).cast("decimal(17,0)")

    cuts = _with_words(cuts, words)
    product = (exact("a") * F.lit(1000).cast("decimal(4,0)")) * exact("words")
    cuts = cuts.withColumn("nominator", product).withColumn("denominator", exact("l") * exact("r"))
    cuts = cuts.withColumn("score", F.expr("nominator div denominator"))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r", "words")).alias("b"))
    best = best.select("lang", "phrase", "b.a", "b.l", "b.r", F.col("b.words").alias("n"), "b.score")

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = best.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS)))
    first = Window.partitionBy("lang", "salt").orderBy(*order)
    short = salted.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= top).drop("salt", "rank")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")
    ranked = short.repartition("lang").withColumn("rank", rank).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _with_words(cuts: DataFrame, words: DataFrame) -> DataFrame:
    """Each cut with its language's number of words."""
    uses = cuts.groupBy("lang").agg(F.count(F.lit(1)).alias("uses"))
    return counted_join(cuts, settle(words.join(uses, "lang")), ["lang"], "uses").drop("uses")
