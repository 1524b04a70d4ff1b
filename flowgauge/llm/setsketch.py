"""Near-duplicates by the Jaccard similarity of word shingles: SetSketch registers, bands, likelihood, exact check.

A document's set is sketched in ``m`` registers. Every element has one value
per register, exponentially distributed: the unit interval is cut into ``m``
equal parts, the element's ``j``-th smallest value falls into the ``j``-th
part and goes to the register that a permutation of its own names, so a
register's least value over a set is that of independent exponentials, and an
element is done as soon as its next part lies above every register's least
value. A register keeps ``floor(1 - log_b(least))``: exponentially spaced, so
two bytes hold sets of any size, and the sketch of a union is the larger of two
registers (``merge``).

Equal registers are as likely as the sets are similar. Four registers make a
band; of 32 bands, two sets with similarity 0.8 share none with probability
5e-8. Sets that share a band are candidates. Their similarity is estimated
from the registers that are larger, smaller and equal, by maximum likelihood
with the known set sizes; what lies more than six deviations below the
threshold goes, and the rest is confirmed on the full sets.

Equal sets are one class, and only classes are compared. In a band's bucket,
classes are not paired with each other: first all of them meet two hubs. Only
buckets that the links so far leave in several components are looked at again,
in cells of bounded blocks: a cell compares the registers and then the sets of
its members inside one task, and gives out links that connect what is to be
connected, never its pairs. No pair that could connect two components is left
out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from flowgauge.llm.bloom import bit_table
from flowgauge.llm.common import text_bytes, text_key, values
from flowgauge.llm.components import components
from flowgauge.llm.joins import counted_join, spread_join
from flowgauge.llm.words import WordHashes, followed_by, mix
from flowgauge.session import settle

SHINGLE_WORDS = 2
#: Similarity of a link, in hundredths.
PERCENT = 80
REGISTERS = 128
BAND_ROWS = 4
BASE, RATE, LARGEST = 1.001, 20.0, 65_534
#: Candidates stay if their estimate is at most so many deviations below the threshold.
MARGIN = 6.0
HUBS = 2
_ONE_WORD = np.uint64(0x5851F42D4C957F2D)
_STEP = np.uint64(0xD1342543DE82EF95)
_CHUNK = 1 << 17
#: Members of a bucket that meet in one cell, and pairs that are looked at together.
BLOCK = 512
_PAIRS = 1 << 14


def shingle_set(text: bytes, hashes: WordHashes, k: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``k``-word shingles of a UTF-8 text.

    A-Z are lowered, words are runs without ASCII white space. Fewer words
    than ``k`` are one shingle; a text without words has none.
    """
    words = hashes.of(text.lower().split())
    if not len(words):
        return words
    short = min(k, len(words))
    out = mix(words[: len(words) - short + 1] ^ (_ONE_WORD + np.uint64(short)))
    for i in range(1, short):
        out = followed_by(out, words[i : len(words) - short + 1 + i])
    return np.unique(out)


def _register(keys: np.ndarray, j: int, m: int) -> np.ndarray:
    """The ``j``-th register of each element's permutation of the ``m`` (a power of two) registers."""
    keys = keys.astype(np.int64)
    x = ((j ^ keys) * ((keys >> 8) | 1)) & (m - 1)
    x ^= x >> 3
    return (x * ((keys >> 16) | 1) + (keys >> 24)) & (m - 1)


def sketches(elements: np.ndarray, owner: np.ndarray, n: int, m: int = REGISTERS) -> np.ndarray:
    """Registers (uint16, ``n`` x ``m``) of ``n`` sets; ``owner`` is the set of each 64-bit element."""
    least = np.full((n, m), float(m))
    flat = least.reshape(-1)
    steps = np.arange(1, m + 1, dtype=np.uint64) * _STEP
    for start in range(0, len(elements), _CHUNK):
        left = elements[start : start + _CHUNK]
        mine = owner[start : start + _CHUNK]
        keys = (mix(left ^ _STEP) >> np.uint64(32)).astype(np.uint32)
        for j in range(m):
            part = (mix(left + steps[j]) >> np.uint64(11)) * 2.0**-53 + j
            np.minimum.at(flat, mine * m + _register(keys, j, m), part)
            go_on = least.max(axis=1)[mine] > j + 1
            if not go_on.any():
                break
            left, mine, keys = left[go_on], mine[go_on], keys[go_on]
    with np.errstate(divide="ignore"):
        value = -np.log1p(-least / m) / RATE
        level = np.floor(1 - np.log(value) / np.log(BASE))
    return np.clip(level, 0, LARGEST + 1).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(a, b)


def _slope(j, larger, smaller, u, v, m: int) -> np.ndarray:
    """Derivative, at similarity ``j``, of the log-likelihood of the register counts; ``u + v = 1`` are the relative sizes."""
    equal = m - larger - smaller
    c, log_b = (BASE - 1) / BASE, np.log(BASE)

    def p(x):
        return -np.log1p(-x * c) / log_b

    def rise(x):  # of p
        return c / ((1 - x * c) * log_b)

    x, y = u - v * j, v - u * j
    with np.errstate(divide="ignore", invalid="ignore"):
        up = np.where(larger > 0, -larger * v * rise(x) / p(x), 0.0)
        down = np.where(smaller > 0, -smaller * u * rise(y) / p(y), 0.0)
        same = np.where(equal > 0, equal * (v * rise(x) + u * rise(y)) / np.maximum(1 - p(x) - p(y), 1e-12), 0.0)
    return up + down + same


def likely_similarity(larger: np.ndarray, smaller: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, m: int) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of sets of sizes ``n_a`` and ``n_b``.

    ``larger`` and ``smaller`` count the registers of the first set that are
    above and below the second's. The derivative of the log-likelihood falls
    in the similarity, so its zero is found by halving.
    """
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(30):
        j = (low + high) / 2
        rising = _slope(j, larger, smaller, u, v, m) > 0
        low, high = np.where(rising, j, low), np.where(rising, high, j)
    return (low + high) / 2


def may_be_similar(x: np.ndarray, y: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """Whether the estimate from registers ``x`` and ``y`` is at most ``MARGIN`` deviations below the threshold.

    The estimate lies above a similarity if the likelihood still rises there.
    """
    m, least = x.shape[1], percent / 100
    floor = max(least - MARGIN * (least * (1 - least) / m) ** 0.5, 0.01)
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    sizes = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)  # alone they bound the similarity
    return sizes & (_slope(floor, (x > y).sum(axis=1), (x < y).sum(axis=1), u, v, m) > 0)


def _intersection(x: np.ndarray, y: np.ndarray) -> int:
    """Common elements of two sorted arrays without repeats."""
    x, y = (x, y) if len(x) <= len(y) else (y, x)
    return int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())


def _sketched(docs: DataFrame, shingle_words: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, class binary, bands array) of every row.

    ``class`` is a 128-bit hash of the set, and ``bands`` are the registers,
    four to a bigint; both are NULL for texts without words.
    """
    rows = docs.select("doc_id", text_key().alias("text_key"), text_bytes().alias("text"))
    out = T.StructType(
        [
            rows.schema["doc_id"],
            rows.schema["text_key"],
            T.StructField("n_shingles", T.LongType()),
            T.StructField("class", T.BinaryType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()

        def flush(ids, keys, sets):
            sizes = [len(s) for s in sets]
            owner = np.repeat(np.arange(len(sets)), sizes)
            registers = sketches(np.concatenate(sets) if sets else np.empty(0, np.uint64), owner, len(sets))
            bands = [None if not n else r for n, r in zip(sizes, registers.view("<i8"))]
            classes = [None if not len(s) else xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            return pa.RecordBatch.from_arrays(
                [
                    ids,
                    keys,
                    pa.array(sizes, pa.int64()),
                    pa.array(classes, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=out.names,
            )

        for batch in batches:
            ids, keys = batch.column(0), batch.column(1)
            at, sets, room = 0, [], _CHUNK
            for i, text in enumerate(values(batch.column(2))):
                sets.append(shingle_set(text, hashes, shingle_words))
                room -= len(sets[-1])
                if room < 0:
                    yield flush(ids[at : i + 1], keys[at : i + 1], sets)
                    at, sets, room = i + 1, [], _CHUNK
            if sets:
                yield flush(ids[at:], keys[at:], sets)

    return rows.mapInArrow(run, out)


def _sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, shingle_words: int) -> DataFrame:
    """(node, items binary) of the classes ``wanted`` (node), from the text of one of their rows.

    A bit table of the wanted rows keeps most other texts from being moved.
    """
    named = settle(classes.join(wanted.hint("merge"), "node", "left_semi").select("node", "rep.doc_id", "rep.text_key"))
    wanted_rows = bit_table(named.select(F.xxhash64("doc_id", "text_key").alias("h")))
    table = docs.sparkSession.sparkContext.broadcast(wanted_rows)
    rows = docs.select("doc_id", text_key().alias("text_key"), text_bytes().alias("text"))
    out = T.StructType([*rows.schema.fields[:2], T.StructField("items", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            batch = batch.filter(pa.array(table.value.may_hold(batch.column(3).to_numpy().view(np.uint64))))
            found = [shingle_set(text, hashes, shingle_words).tobytes() for text in values(batch.column(2))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.binary())], names=out.names)

    sets = settle(rows.withColumn("h", F.xxhash64("doc_id", "text_key")).mapInArrow(run, out))
    left, right = sets.alias("s"), named.hint("merge").alias("n")
    same_row = F.col("s.doc_id").eqNullSafe(F.col("n.doc_id")) & (F.col("s.text_key") == F.col("n.text_key"))
    # rows may repeat, their sets are equal
    return left.join(right, same_row).select("node", "items").dropDuplicates(["node"])


def _registers(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().view("<u2").reshape(len(column), -1)


def _items(column: pa.Array) -> Iterator[np.ndarray]:
    """The sets of a binary column, without copies."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    for start, end in zip(ends[:-1], ends[1:]):
        yield np.frombuffer(data, dtype=np.uint8, count=end - start, offset=start).view("<u8")


def _confirmed(met: DataFrame, sketched: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) among the written pairs (node, hub): those that may be similar, confirmed on the full sets.

    A class has a few hubs, but a hub may have very many classes.
    """
    names = ["n", "bands", "items"]
    pairs = spread_join(met, sketched.toDF("hub", *[f"hub_{c}" for c in names]), "hub")
    pairs = pairs.join(sketched.hint("merge"), "node")

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                at = {name: part.column(i) for i, name in enumerate(part.schema.names)}
                n, m = (at[c].to_numpy() for c in ("n", "hub_n"))
                good = may_be_similar(
                    _registers(at["bands"]), _registers(at["hub_bands"]), n.astype(float), m.astype(float), percent
                )
                for i, (x, y) in enumerate(zip(_items(at["items"]), _items(at["hub_items"]))):
                    if good[i]:
                        both = _intersection(x, y)
                        good[i] = 100 * both >= percent * (len(x) + len(y) - both)
                found = part.filter(pa.array(good))
                yield pa.RecordBatch.from_arrays([found.column(0), found.column(1)], names=["a", "b"])

    return pairs.select("node", "hub", *names, *[f"hub_{c}" for c in names]).mapInArrow(similar, "a bigint, b bigint")


def _labels(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, root) of all ``nodes``, also of those without links."""
    return nodes.join(roots.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node"))


def _hubs(shared: DataFrame) -> DataFrame:
    """(node, hub): each bucket's classes with the bucket's hubs, each pair once."""
    hubs = [F.min_by("node", F.xxhash64("node", F.lit(i))) for i in range(HUBS)]
    hubs = shared.groupBy("t", "key").agg(F.array_distinct(F.array(*hubs)).alias("hubs"), F.count(F.lit(1)).alias("n"))
    met = counted_join(shared, settle(hubs), ["t", "key"], "n").select("node", F.explode("hubs").alias("hub"))
    return met.filter("node != hub").distinct()


def _cells(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets with more than one component, dealt over cells (t, key, i, j).

    The members of a bucket's largest component need not meet each other; the
    others ("minor") meet all. So minor ones are dealt over rows ``i`` and all
    members over columns ``j`` of a grid of blocks, and a cell holds one block
    of each, however many members a bucket has.
    """
    labelled = settle(shared.join(labels.hint("merge"), "node"))
    parts = labelled.groupBy("t", "key", "root").agg(F.count(F.lit(1)).alias("n"))
    buckets = parts.groupBy("t", "key").agg(F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("n"))
    mixed = settle(buckets.filter("top.n < n").select("t", "key", F.col("top.root").alias("major"), "n", F.expr("n - top.n").alias("n_minor")))
    rows = settle(counted_join(labelled, mixed, ["t", "key"], "n"))

    def block(n: str) -> Column:
        return F.pmod(F.xxhash64("node"), F.ceil(F.col(n) / F.lit(BLOCK))).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.ceil(F.col(n) / F.lit(BLOCK)).cast("int") - 1))

    names = ["t", "key", "i", "j", "minor", "node", "root"]
    minor = rows.filter("root != major").withColumn("i", block("n_minor")).withColumn("j", every("n"))
    members = rows.withColumn("j", block("n")).withColumn("i", every("n_minor"))
    dealt = minor.withColumn("minor", F.lit(True)).select(*names)
    return dealt.unionByName(members.withColumn("minor", F.lit(False)).select(*names))


def _in_cells(rows: DataFrame, percent: int, confirm: bool) -> DataFrame:
    """Compare the minor members of each cell with its others.

    Pairs of one component and pairs that share an earlier band (they meet
    there) are left out, then those that can't be similar enough. Without
    ``confirm`` the result is the rows (t, key, i, j, minor, node, root) of members
    that are left in some pair; with it, the sets are compared and the result
    is links (a, b) that join the cell's members like all its links would.
    """
    at = ["t", "key", "i", "j"]
    used = [*at, "minor", "node", "root", "n", "bands", *(["items"] if confirm else [])]
    out = "a bigint, b bigint" if confirm else "t int, key bigint, i int, j int, minor boolean, node bigint, root bigint"
    out_schema = to_arrow_schema(T.StructType.fromDDL(out))

    def pairs_of(cell: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Places of the pairs that may be similar."""
        node, root, n = (cell.column(c).to_numpy() for c in ("node", "root", "n"))
        registers = _registers(cell.column("bands").combine_chunks())
        bands = registers.view("<i8")
        minor = cell.column("minor").to_numpy()
        xs, ys, t = np.flatnonzero(minor), np.flatnonzero(~minor), cell.column("t")[0].as_py()
        left, right = [], []
        step = max(1, _PAIRS // max(len(ys), 1))
        for start in range(0, len(xs), step):
            x = xs[start : start + step]
            apart = root[x][:, None] != root[ys][None, :]
            for earlier in range(t):
                apart &= bands[x, earlier][:, None] != bands[ys, earlier][None, :]
            a, b = np.nonzero(apart)
            a, b = x[a], ys[b]
            good = may_be_similar(registers[a], registers[b], n[a].astype(float), n[b].astype(float), percent)
            left.append(a[good])
            right.append(b[good])
        return np.concatenate(left), np.concatenate(right)

    def compare(cell: pa.Table) -> pa.RecordBatch:
        a, b = pairs_of(cell)
        if not confirm:
            found = cell.select(out_schema.names).take(pa.array(np.union1d(a, b)))
            return found.combine_chunks().to_batches()[0] if found.num_rows else None
        node, label, n = cell.column("node").to_numpy(), cell.column("root").to_numpy().copy(), cell.column("n").to_numpy()
        items = list(_items(cell.column("items").combine_chunks()))
        links = []
        for x, y in zip(a.tolist(), b.tolist()):
            if label[x] == label[y]:  # by links of this cell
                continue
            both = _intersection(items[x], items[y])
            if 100 * both >= percent * (int(n[x]) + int(n[y]) - both):
                label[label == label[y]] = label[x]
                links.append((min(node[x], node[y]), max(node[x], node[y])))
        if links:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], names=out_schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, mark = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy().astype(np.int64) for c in at], axis=1)
            starts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), batch.num_rows]
            for start, end in zip(starts[:-1], starts[1:]):
                if mark != (now := tuple(keys[start])) and kept:
                    if (found := compare(pa.Table.from_batches(kept))) is not None:
                        yield found
                    kept = []
                mark = now
                kept.append(batch.slice(start, end - start))
        if kept and (found := compare(pa.Table.from_batches(kept))) is not None:
            yield found

    together = rows.select(*used).repartition(*at).sortWithinPartitions(*at)
    return together.mapInArrow(run, out)


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, text_key.

    Documents are linked if ``100 * intersection >= percent * union`` holds
    for their shingle sets; ``component_id`` is the smallest doc_id that is
    reachable. NULL and empty texts have no shingles and no links. Repeated
    rows give repeated rows; rows without a doc_id get their group's number,
    or NULL if nobody in the group has one, and are not kept. Other columns of
    ``docs`` are not read.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent is between 50 and 100")
    own = settle(_sketched(docs, shingle_words))
    classes = own.filter("class IS NOT NULL").groupBy("class").agg(
        F.min("doc_id").alias("least"),
        F.min(F.struct("doc_id", "text_key")).alias("rep"),
        F.any_value("n_shingles").alias("n"),
        F.any_value("bands").alias("bands"),
        F.count(F.lit(1)).alias("rows"),
    )
    classes = settle(classes.withColumn("node", F.monotonically_increasing_id()))
    nodes = classes.select("node")

    filed = classes.select("node", F.posexplode("bands").alias("t", "key"))
    sizes = filed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = settle(filed.join(sizes.drop("n").hint("merge"), ["t", "key"]))

    met = settle(_hubs(shared))
    ends = met.select(F.explode(F.array("node", "hub")).alias("node")).distinct()
    sketch = classes.select("node", "n", "bands")
    sets = settle(_sets(docs, classes, ends, shingle_words))
    sketched = sketch.join(sets.hint("merge"), "node")
    roots = components(_confirmed(met, sketched, percent))

    cells = settle(_cells(shared, _labels(nodes, roots)))
    left = settle(_in_cells(cells.join(sketch.hint("merge"), "node"), percent, confirm=False))
    if not left.isEmpty():
        # every class of a shared bucket has met a hub, so its set is known
        links = _in_cells(left.join(sketched.hint("merge"), "node"), percent, confirm=True)
        roots = components(links.unionByName(roots.toDF("a", "b")))
    placed = settle(_labels(classes.select("class", "node", "least", "rows"), roots))
    ids = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = settle(placed.join(ids.hint("merge"), "root").select("class", "component_id", "rows"))
    found = counted_join(own.drop("bands"), of_class, ["class"], "rows", "left")
    # a text without words is alone, whoever else has none
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    kept = F.coalesce(F.col("doc_id") == component, F.lit(False))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"), "text_key")
