"""Benchmark items in documents, also with other numbers, names and units.

Both sides are turned into templates: numbers, capitalised words and units
after a number become typed placeholders; everything else is lowered and loses
its punctuation. Windows of five words are joined by hash, in three forms: all
capitalised words as placeholders, only those inside a sentence, and none (with
numbers and units as they are). A matched window leads to an alignment (its
place in the document minus its place in the item), on which both are compared
word by word: a window counts if it's the same, or if its plain words are the
same and each slot holds the value that the most places of the alignment give
to the item's value. A document holds an item if 0.8 of its windows count.

DataFrame functions only. The items' windows are broadcast, in blocks of a
fixed number of rows, so documents are matched in place. What leaves the match
are distinct alignments without words, however often a window is shared; only
documents with one are moved, once, and an alignment gets the words beside it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.llm.common import text_key, whole_text, without
from flowgauge.llm.joins import spread_join
from flowgauge.session import settle

WINDOW_WORDS = 5
SHARE = 0.8
#: A window with fewer plain words is compared word by word.
PLAIN_WORDS = 2
#: Rows of the items' windows that are broadcast at once (about 100 bytes each).
BLOCK_ROWS = 250_000
_NAME, _NUMBER, _UNIT, _POINT, _FIRST = "\x01", "\x02", "\x03", "\x04", "\x05"
#: Words that are a unit if they follow a number.
UNITS = (
    "mm cm m km ft in inch inches yd mi mile miles g mg kg lb lbs oz ton tons l ml litre litres liter liters gallon "
    "gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "usd eur gbp dollar dollars euro euros cent cents pound pounds percent degree degrees mph kmh kwh watt watts volt volts"
).split()


def marked_words(text: Column) -> Column:
    """Words in order: numbers, units and capitalised words bear a mark and are lowered like all others."""
    text = F.regexp_replace(text, r" (?<=[\p{Ll}\p{N},;:] )(\p{Lu}\p{Ll}+)", f" {_NAME}$1")
    text = F.regexp_replace(text, rf"\p{{Lu}}(?=\p{{Ll}})(?<![\p{{L}}\p{{N}}{_NAME}].)", f"{_FIRST}$0")
    text = F.regexp_replace(F.lower(text), r"[.,](?<=\p{Nd}.)(?=\p{Nd})", _POINT)
    text = F.regexp_replace(text, rf"[\p{{Nd}}{_POINT}]+", f" {_NUMBER}$0 ")
    text = F.regexp_replace(text, rf" (?<=\p{{Nd}} ) *{_FIRST}?({'|'.join(UNITS)})(?![\p{{L}}\p{{N}}])", f" {_UNIT}$1 ")
    text = F.trim(F.regexp_replace(text, rf"[^\p{{L}}\p{{N}}{_NAME}-{_FIRST}]+", " "))
    return F.filter(F.split(text, " "), lambda w: w != "")


def is_slot(word: Column) -> Column:
    return word < _FIRST


def bare(word: Column) -> Column:
    """A word without its mark."""
    return F.when(word < "\x06", F.substring(word, 2, 1 << 20)).otherwise(word)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where it's used inside a lambda."""
    return F.transform(F.array(value), body)[0]


#: A word in the three forms: capitalised words are placeholders, only those inside a sentence are (numbers and units in both), none is.
_FORMS = (
    lambda w: F.when(w < "\x06", F.when(is_slot(w), F.substring(w, 1, 1)).otherwise(_NAME)).otherwise(w),
    lambda w: F.when(w < "\x06", F.when(is_slot(w), F.substring(w, 1, 1)).otherwise(bare(w))).otherwise(w),
    bare,
)


def _moved(numbers: Column, by: Column) -> Column:
    return F.transform(numbers, lambda i: i + by)


def window_hashes(words: Column, form: Callable[[Column], Column], starts: Column, size: int) -> Column:
    """A hash per window that starts there; fewer words than a window are one window."""
    hashes = F.transform(words, lambda w: F.xxhash64(form(w)))
    return _let(hashes, lambda hashes: F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i + 1, size))))


def filed_windows(words: Column, size: int) -> Column:
    """(at, hash) of every window in the first form, and of those that the second and the third one change.

    ``at`` is the window's place plus the number of windows times the form.
    """
    n = F.greatest(F.size(words) - size + 1, F.lit(1))

    def around(places: Column) -> Column:
        """The windows that hold one of the words."""
        near = F.transform(places, lambda j: F.sequence(F.greatest(j - size + 1, F.lit(0)), F.least(j, n - 1)))
        return F.array_distinct(F.flatten(near))

    def filed(marked: Column) -> Column:
        first = around(F.filter(marked, lambda j: ~is_slot(F.get(words, j))))
        slots = around(F.filter(marked, lambda j: is_slot(F.get(words, j))))
        return _let(first, lambda first: _let(slots, lambda slots: joined((F.sequence(F.lit(0), n - 1), first, slots))))

    def joined(starts: tuple[Column, ...]) -> Column:
        at = F.concat(*[_moved(s, n * k) for k, s in enumerate(starts)])
        hashes = F.concat(*[window_hashes(words, form, s, size) for form, s in zip(_FORMS, starts)])
        return F.struct(at.alias("at"), hashes.alias("hash"))

    marked = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda j: F.get(words, j) < "\x06")
    return F.when(F.size(words) > 0, _let(marked, filed))


def windows(table: DataFrame, *keys: str, size: int = WINDOW_WORDS) -> DataFrame:
    """(keys, words, pos, form, hash): every window of every text in its forms; NULL counts as empty."""
    rows = table.select(*keys, marked_words(whole_text()).alias("words"))
    rows = rows.select("*", filed_windows(F.col("words"), size).alias("filed"))
    # the outer form: an inner explode would compute the windows twice, once to filter on them
    rows = rows.select(*keys, "words", F.col("filed.at").alias("places"), F.posexplode_outer("filed.hash").alias("at", "hash"))
    n, at = F.greatest(F.size("words") - size + 1, F.lit(1)), F.get("places", F.col("at"))
    return rows.select(*keys, "words", F.pmod(at, n).alias("pos"), F.floor(at / n).alias("form"), "hash")


def hash_before(size: int) -> Column:
    """The hash of the window before, in the same form; NULL for the first.

    Without lambdas: in a join's condition they would end the generated code,
    and every window of a text would be kept with a copy of its words.
    """
    part = [F.get("words", F.col("pos") - 1 + k) for k in range(size)]
    capital, placed, plain = (F.xxhash64(F.array(*[F.xxhash64(form(w)) for w in part])) for form in _FORMS)
    form = F.col("form")
    return F.when(F.col("pos") > 0, F.when(form == 0, capital).when(form == 1, placed).otherwise(plain))


def item_words(benchmark: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """(item_id, item_key, text, mine, n_windows, needed) of every item; equal rows of one item count once.

    ``mine`` is (word, kind, key) of every word: kind is the mark of a slot or
    empty, and words with one key must have one value. A word seen capitalised
    inside a sentence is a name wherever it stands. A number is told apart by
    the unit after it. ``needed`` plain words make a window match by template.
    """
    items = benchmark.select("item_id", "text").distinct().filter(F.size(marked_words(whole_text())) > 0)
    items = items.select("item_id", text_key().alias("item_key"), "text", marked_words(whole_text()).alias("words"))

    def described(words: Column, names: Column) -> Column:
        def one(w: Column, i: Column) -> Column:
            kind = F.when(w.startswith(_NUMBER) | w.startswith(_UNIT), F.substring(w, 1, 1))
            kind = kind.when(F.array_contains(names, bare(w)), _NAME).otherwise("")
            unit = F.when(w.startswith(_NUMBER) & F.get(words, i + 1).startswith(_UNIT), F.get(words, i + 1))
            key = F.when(kind != "", F.concat(kind, bare(w), F.coalesce(unit, F.lit(""))))
            return F.struct(bare(w).alias("word"), kind.alias("kind"), key.alias("key"))

        return F.transform(words, one)

    names = F.transform(F.filter("words", lambda w: w.startswith(_NAME)), bare)
    items = items.select("item_id", "item_key", "text", _let(names, lambda x: described(F.col("words"), x)).alias("mine"))
    n = F.greatest(F.size("mine") - size + 1, F.lit(1))
    plain = F.transform(F.sequence(F.lit(1), n), lambda i: _plain_words(F.slice("mine", i, size)))
    least = F.least(F.lit(PLAIN_WORDS), F.size("mine"))
    return items.select("*", n.alias("n_windows"), F.when(F.array_max(plain) >= least, least).otherwise(1).alias("needed"))


def _plain_words(part: Column) -> Column:
    return F.size(F.filter(part, lambda m: m["key"].isNull()))


def item_windows(texts: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """(item_key, length, ipos, hash, before) of the windows that documents are matched with, one row of ``texts`` per item_key."""
    found = windows(texts, "item_key", "needed", size=size)
    part = F.slice("words", F.col("pos") + 1, size)
    edge = F.when(F.col("form") == 0, "\x06").otherwise(_FIRST)
    plain = (F.col("form") == 2) | (F.size(F.filter(part, lambda w: w >= edge)) >= F.col("needed"))
    found = found.withColumn("plain", plain).filter("plain AND hash IS NOT NULL")
    length, before = F.size("words").alias("length"), hash_before(size).alias("before")
    ways = found.select("item_key", length, F.col("pos").alias("ipos"), "hash", before)
    filed = Window.partitionBy("item_key").orderBy("ipos").rangeBetween(-1, -1)
    hit = F.array_contains(F.collect_set("hash").over(filed), F.col("before"))
    return ways.withColumn("before", F.when(hit, F.col("before")))


def alignments(docs: DataFrame, items: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """(doc, item_key, length, shift): distinct alignments that one block of the items' windows leads to.

    The first of matching windows in a row leads to the alignment. The words
    stay behind: they would be copied once per hit.
    """
    found = windows(docs.select(_document(), "text"), "doc", size=size).join(F.broadcast(items), "hash")
    found = found.filter((F.col("pos") == 0) | F.col("before").isNull() | (F.col("before") != hash_before(size)))
    return found.select("doc", "item_key", "length", (F.col("pos") - F.col("ipos")).alias("shift")).distinct()


def _document() -> Column:
    """(doc_id, text_key) of a row; a NULL id equals itself inside of it."""
    return F.struct("doc_id", text_key().alias("text_key")).alias("doc")


def matches(docs: DataFrame, found: DataFrame, texts: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """(doc, item_key, n_windows, ipos): windows of items that count on the alignments ``found``, a written table.

    Only documents with an alignment are moved. An alignment gets the words
    that lie beside its item, and those of a document with very many alignments
    are dealt over copies of it.
    """
    here = docs.select(_document(), "text").join(found.select("doc").distinct(), "doc", "left_semi")
    here = here.dropDuplicates(["doc"]).select("doc", marked_words(whole_text()).alias("words"))
    first = F.greatest("shift", F.lit(0))
    beside = F.slice("words", first + 1, F.greatest(F.col("shift") + F.col("length") - first, F.lit(0)))
    near = spread_join(found, here, "doc").select("doc", "item_key", beside.alias("words"), (F.col("shift") - first).alias("shift"))
    near = near.join(texts.select("item_key", "mine", "n_windows", "needed"), "item_key")
    places = covered(F.col("mine"), F.col("words"), F.col("shift"), F.col("n_windows"), F.col("needed"), size)
    # the outer form here too: the inner one would compare twice
    near = near.select("doc", "item_key", "n_windows", F.explode_outer(places).alias("ipos"))
    return near.filter("ipos IS NOT NULL")


def covered(mine: Column, words: Column, shift: Column, n: Column, needed: Column, size: int) -> Column:
    """Windows of an item that an alignment covers, by position.

    A window counts if it's the same word by word. If one with ``needed``
    plain words is consistent, so does every consistent one: its plain words
    are the same, and its slots hold the value that the most places of the
    alignment give to the item's value (its own, if as many do).
    """

    def spot(m: Column, i: Column) -> Column:
        word = F.get(words, i + shift)
        literal = F.coalesce(bare(word) == m["word"], F.lit(False))
        number, unit = word.startswith(_NUMBER), word.startswith(_UNIT)
        fits = F.when(m["kind"] == _NUMBER, number).when(m["kind"] == _UNIT, unit).when(m["kind"] == _NAME, ~number & ~unit)
        fits = F.coalesce(fits, F.lit(False)) | literal
        return F.struct(m["key"].alias("key"), bare(word).alias("value"), literal.alias("literal"), fits.alias("fits"))

    def votes(spots: Column) -> Column:
        """(places, whether the item's own, value, key) of every value of a slot."""
        pairs = F.filter(spots, lambda s: s["key"].isNotNull() & s["fits"])
        count = lambda pairs, p: F.size(F.filter(pairs, lambda q: q == p))
        return _let(pairs, lambda pairs: F.transform(
            F.array_distinct(pairs), lambda p: F.struct(count(pairs, p).alias("n"), p["literal"], p["value"], p["key"].alias("key"))
        ))

    def judged(spots: Column, votes: Column) -> Column:
        def one(s: Column) -> Column:
            best = F.array_max(F.filter(votes, lambda v: v["key"] == s["key"]))["value"]
            agrees = s["fits"] & (s["key"].isNull() | F.coalesce(best == s["value"], F.lit(False)))
            return F.struct(s["key"].alias("key"), s["literal"].alias("literal"), agrees.alias("agrees"))

        return F.transform(spots, one)

    def window(spots: Column, i: Column) -> Column:
        part = F.slice(spots, i + 1, size)
        agrees = F.forall(part, lambda s: s["agrees"])
        return F.struct(
            i.alias("i"), F.forall(part, lambda s: s["literal"]).alias("literal"), agrees.alias("agrees"),
            (agrees & (_plain_words(part) >= needed)).alias("leads"),
        )

    def places(all_: Column) -> Column:
        led = F.exists(all_, lambda w: w["leads"])
        return _let(led, lambda led: F.transform(F.filter(all_, lambda w: w["literal"] | (led & w["agrees"])), lambda w: w["i"]))

    spots = _let(F.transform(mine, spot), lambda s: _let(votes(s), lambda v: judged(s, v)))
    return _let(spots, lambda s: _let(F.transform(F.sequence(F.lit(0), n - 1), lambda i: window(s, i)), places))


def leaks(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS, share: float = SHARE) -> DataFrame:
    """One row per document and item it holds: doc_id, text_key, item_id, n_windows, n_found, share.

    A document without such an item has no row. Texts of fewer words than a
    window are one window; empty and NULL texts have none and match nothing.
    Repeated rows of a document add nothing; rows of one doc_id (or of none)
    with different texts are different documents. If an item_id has several
    texts, they count as one where they have equally many windows. Other
    columns are not read.
    """
    parts = settle(item_words(benchmark, size))
    texts = settle(parts.dropDuplicates(["item_key"]))
    items = settle(item_windows(texts, size))
    blocks = max(1, -(-items.count() // BLOCK_ROWS))
    of_block = F.pmod(F.xxhash64("hash", "item_key", "ipos"), F.lit(blocks)) if blocks > 1 else F.lit(0)
    found = [alignments(docs, items.filter(of_block == b), size) for b in range(blocks)]
    found = settle(reduce(DataFrame.unionByName, found).distinct() if blocks > 1 else found[0])
    places = matches(docs, found, texts, size).join(parts.select("item_id", "item_key"), "item_key")
    n = places.groupBy("doc", "item_id", "n_windows").agg(F.count_distinct("ipos").alias("n_found"))
    part = F.col("n_found") / F.col("n_windows")
    n = n.select("doc.doc_id", "doc.text_key", "item_id", "n_windows", "n_found", part.alias("share"))
    return n.filter(F.col("n_found") >= F.ceil(F.col("n_windows") * share - 1e-9))


def remove_leaks(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS, share: float = SHARE) -> DataFrame:
    """``docs`` without the documents that hold an item, all columns as they are."""
    return without(docs, settle(leaks(docs, benchmark, size, share).select("doc_id", "text_key").distinct()))
