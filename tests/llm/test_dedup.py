"""Near and exact duplicates, repeated lines, and components against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import xxhash
from llm_helpers import ordered, rows_of
from pyspark.sql import functions as F

from flowgauge.llm import exact_dedup, line_dedup, simhash
from flowgauge.llm.components import components

WORDS = "the of and re on in er th es an at ti or en".split()


def roots(n, links):
    """Smallest member of each node's component."""
    of = list(range(n))

    def find(i):
        while of[i] != i:
            of[i] = of[of[i]]
            i = of[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        of[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def plain_fingerprint(text):
    """Bit by bit, from the definition."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            words, word = words + [word] * bool(word), ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("links", [[], [(i, i + 1) for i in range(70)], [(0, i) for i in range(1, 60)] + [(80, 81), (81, 95)]])
def test_components(spark, links):
    mixed = [(a, b) if a % 2 else (b, a) for a, b in links] + [(3, 3)]
    random.Random(0).shuffle(mixed)
    found = {r.node: r.root for r in components(spark.createDataFrame(mixed, "a bigint, b bigint")).collect()}
    assert found == {i: r for i, r in enumerate(roots(100, links)) if i != r}


@pytest.mark.parametrize("max_bits", [0, 1, 2])
@pytest.mark.parametrize("paired_block", [0, 3, 10_000])
def test_links_connect_what_is_close(spark, max_bits, paired_block):
    rng = random.Random(max_bits)
    prints = set()
    for base in [rng.getrandbits(64) for _ in range(6)] + [0, (1 << 64) - 1]:
        for _ in range(25):
            near = base
            for bit in rng.sample(range(64), rng.randint(0, 4)):
                near ^= 1 << bit
            prints.add(near)
    prints = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    df = spark.createDataFrame([(p,) for p in prints], "fp bigint")
    found = {tuple(sorted(r)) for r in simhash.links(df, max_bits, paired_block).collect()}
    close = {
        (a, b)
        for i, a in enumerate(prints)
        for b in prints[i + 1 :]
        if ((a ^ b) & (1 << 64) - 1).bit_count() <= max_bits
    }
    assert found <= close
    at = {p: i for i, p in enumerate(prints)}
    number = lambda pairs: roots(len(prints), [(at[a], at[b]) for a, b in pairs])
    assert number(found) == number(close)


def texts():
    rng = random.Random(5)
    long = " ".join(rng.choices(WORDS, k=70_000))
    near = [" ".join(rng.choices(WORDS, k=300))]
    near += [near[0].replace("the", "The", 3), near[0] + " more", near[0].replace(" of", " OF")]
    return [*near, "", None, " \n\t", "one", "One two", "one\x0btwo", "a\x1cb c d", "É é", "é é", long, long + " end", *near[:2]]


def test_near_duplicates_against_brute_force(make):
    rows = list(enumerate(texts())) + [(3, texts()[3]), (None, "one"), (None, "nobody else says this"), (40, "x y z")]
    prints = [plain_fingerprint(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    group = roots(len(rows), links)
    least = {g: min((rows[i][0] for i in range(len(rows)) if group[i] == g and rows[i][0] is not None), default=None) for g in set(group)}
    wanted = ordered((i, f"{p:016x}", least[g]) for (i, _), p, g in zip(rows, prints, group))
    for paired_block in (1, 32):
        found = simhash.near_duplicates(make(rows), paired_block=paired_block)
        assert rows_of(found, "doc_id", "fingerprint", "component_id") == wanted
    kept = simhash.keep_one_of_each(make(rows))
    assert kept.columns == make(rows).columns
    ids = Counter(r.doc_id for r in kept.collect())
    expected = Counter(i for (i, _), g in zip(rows, group) if i == least[g])
    assert ids == expected and ids[3] in (0, 2)


def test_no_documents(make):
    empty = make([])
    for found in (
        simhash.near_duplicates(empty),
        simhash.keep_one_of_each(empty),
        exact_dedup.exact_duplicates(empty),
        line_dedup.line_counts(empty),
        line_dedup.drop_repeated_lines(empty),
    ):
        assert found.count() == 0


@pytest.mark.parametrize("bits_per_row", [1, 16])
def test_exact_duplicates(make, bits_per_row):
    rows = list(enumerate(texts())) + [(3, texts()[3]), (None, "one"), (None, "alone"), (99, "é"), (98, "é")]
    found = exact_dedup.exact_duplicates(make(rows), bits_per_row)
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    wanted = []
    for i, t in rows:
        own = groups[t or ""]
        keep = max((k for k in own if k is not None), default=None)
        wanted.append((i, keep, len(own), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    assert rows_of(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == ordered(wanted)


def test_only_possibly_repeated_rows_are_marked(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 3900).alias("text"))
    tested = exact_dedup.possibly_repeated(exact_dedup.text_digests(docs), 1 << 16)
    marked = {r.doc_id for r in tested.filter("maybe").collect()}
    assert marked >= {i for i in range(4000) if i < 100 or i >= 3900}
    assert len(marked) < 400


def brute_lines(rows, min_chars=40, min_docs=5):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(holders[key(x)]) >= min_docs and i != max(holders[key(x)]))]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return ordered(out)


def test_line_dedup_against_brute_force(make):
    shared = "This line stands in very many of the documents, again."
    accents = "é" * 39, "é" * 40, "x" * 39 + "É", "x" * 39 + "é"
    rows = [(i, f"own line {i}\n  {shared.upper() if i % 2 else shared}\t\n\n{accents[i % 4]}\n{shared}") for i in range(24)]
    rows += [(30, None), (31, ""), (32, "\n\n"), (33, shared), (None, f"{shared}\nmine"), (5, rows[5][1]), (34, (shared + "\n") * 3000)]
    rows += [(40 + i, "four documents only hold this line, which then stays") for i in range(4)]
    found = line_dedup.line_counts(make(rows))
    assert rows_of(found, "doc_id", "n_lines", "n_dropped", "text") == brute_lines(rows)
    kept = line_dedup.drop_repeated_lines(make(rows))
    assert kept.columns == make(rows).columns
    assert rows_of(kept, "doc_id", "text") == ordered((i, t) for i, _, _, t in brute_lines(rows))
