"""SetSketch near-duplicates, collocations and ranked search: brute force, odd rows and the parts."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from llm_helpers import rows_of

from flowgauge.llm import bloom, collocations, joins, lexical_search, setsketch
from flowgauge.llm.common import table
from flowgauge.llm.words import WordHashes, followed_by, head_of, mix, unmix

# ---- SetSketch --------------------------------------------------------------


def shingles(text, k=2):
    words = re.findall(r"[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if len(words) >= k else frozenset(words)


def brute_near(rows, percent=80, k=2):
    """(doc_id, n_shingles, component_id, kept) of rows with ids, every pair compared."""
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and find(i) != find(j) and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                if 100 * len(x & y) >= percent * len(x | y):
                    root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    found = [least[find(i)] if sets[i] else rows[i][0] for i in range(len(rows))]
    return sorted((doc_id, len(sets[i]), found[i], doc_id == found[i]) for i, (doc_id, _) in enumerate(rows))


NEAR = ["doc_id", "n_shingles", "component_id", "kept"]


def family(rng, n, words=40, edits=9):
    base = [f"w{rng.randint(0, 500)}" for _ in range(words)]
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(len(copy))] = f"x{rng.randint(0, 99)}"
        yield " ".join(copy)


@pytest.mark.parametrize("block", [512, 7])
def test_near_duplicates_against_all_pairs(make, monkeypatch, block):
    monkeypatch.setattr(setsketch, "BLOCK", block)
    monkeypatch.setattr(joins, "ROWS_PER_COPY", 5)
    rng = random.Random(block)
    texts = [*family(rng, 120), *family(rng, 30, 12, 2), *family(rng, 20, 300, 40), "A b", "a B", "a", "A", "", None, " \t\n"]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    assert rows_of(setsketch.near_duplicates(make(rows)), *NEAR) == brute_near(rows)


def test_near_duplicates_of_a_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    assert rows_of(setsketch.near_duplicates(docs), *NEAR) == brute_near([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_near_duplicates_of_odd_rows(make):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(3, "one two three"), (3, "one two three"), (None, "ONE two three"), (4, "other words here"), (None, "alone in here"),
            (None, None), (9, long), (8, long + " end"), (3, "")]
    found = Counter(map(tuple, setsketch.near_duplicates(make(rows)).select(*NEAR).collect()))
    assert found == Counter([(3, 2, 3, True)] * 2 + [(None, 2, 3, False), (4, 2, 4, True), (None, 2, None, False), (None, 0, None, False),
                            (9, 59_999, 8, False), (8, 60_000, 8, True), (3, 0, 3, True)])
    assert setsketch.near_duplicates(make([])).count() == 0


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    errors = []
    for n, common in ((5, 3), (400, 300), (3000, 2000), (900, 0)):
        pool = rng.integers(0, 2**63, 2 * n - common, dtype=np.uint64)
        a, b = pool[:n], pool[n - common :]
        x, y = setsketch.sketches(np.concatenate([a, b]), np.repeat([0, 1], [n, len(b)]), 2)
        whole = setsketch.sketches(pool, np.zeros(len(pool), np.int64), 1)[0]
        assert (setsketch.merge(x, y) == whole).all()
        counts = [np.array([(x.astype(int) > y).sum()]), np.array([(x.astype(int) < y).sum()])]
        sizes = [np.array([float(n)]), np.array([float(len(b))])]
        errors.append(setsketch.likely_similarity(*counts, *sizes, 128)[0] - common / (2 * n - common))
    assert max(map(abs, errors)) < 0.16  # four deviations of 128 registers


def test_bit_table_holds_what_was_put_in(spark):
    hashes = spark.range(5000).selectExpr("xxhash64(id) AS h")
    found = bloom.bit_table(hashes)
    own = np.array([r.h for r in hashes.collect()])
    others = np.array([r.h for r in spark.range(5000, 25_000).selectExpr("xxhash64(id) AS h").collect()])
    assert found.may_hold(own).all() and found.may_hold(others).mean() < 0.02
    assert not bloom.bit_table(spark.range(0).selectExpr("id AS h")).may_hold(own).any()


# ---- collocations -----------------------------------------------------------


def brute_collocations(rows, least, top):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall("[^ \t]+", piece)
            totals[lang or "und"] += len(words)
            for k in range(1, 6):
                counts.update((lang or "und", tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    often = {p: n for p, n in counts.items() if n >= least}
    covered = Counter()
    for (lang, p), n in often.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                covered[lang, p[i : i + k]] = max(covered[lang, p[i : i + k]], n)
    out = []
    for (lang, p), a in often.items():
        if len(p) > 1 and covered[lang, p] < a:
            n = totals[lang]
            cuts = [(1000 * a * n // (often[lang, p[:k]] * often[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out.append((lang, -score, -a, " ".join(p), often[lang, p[:k]], often[lang, p[k:]], n))
    ranked, rank = [], Counter()
    for lang, score, a, p, left, right, n in sorted(out, key=lambda x: (*x[:3], x[3].encode())):
        rank[lang] += 1
        if rank[lang] <= top:
            ranked.append((lang, rank[lang], p, -a, left, right, n, -score))
    return sorted(ranked)


@pytest.mark.parametrize("every,tokens", [(1, 1 << 20), (3, 300), (1000, 1 << 20)])
def test_collocations_against_brute_force(spark, monkeypatch, every, tokens):
    monkeypatch.setattr(collocations, "_TOKENS", tokens)
    rng = random.Random(every)
    words = ["the", "of", "New", "York", "City", "é", "\x1c", "a", "a"]
    rows = [(rng.choice(["en", "fr", None, "und"]), "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", ". ", "\n"]) for _ in range(60))) for _ in range(60)]
    rows += [("en", None), ("fr", ""), ("en", "a " * 4000), ("de", "rare")]
    docs = spark.createDataFrame([(i % 50, t, lang, "x") for i, (lang, t) in enumerate(rows)], "doc_id int, text string, lang string, rank string")
    found = collocations.collocations(docs, least=8, top=9, sample_every=every)
    assert sorted(map(tuple, found.collect())) == brute_collocations(rows, 8, 9)
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_a_head_is_found_from_its_sequence():
    hashes = np.random.default_rng(1).integers(0, 1 << 64, (2, 1000), dtype=np.uint64)
    assert (unmix(mix(hashes[0])) == hashes[0]).all()
    assert (head_of(followed_by(*hashes), hashes[1]) == hashes[0]).all()


@pytest.mark.parametrize("shared_hash", [False, True])
def test_phrases_are_spelled_by_joins_or_counted_by_text(spark, monkeypatch, shared_hash):
    by_text, by_hash = collocations._text_counts, collocations._hash_counts
    passes = []

    def hashes(*args):  # as if some phrases of one hash had another last word
        return by_hash(*args).withColumn("other", F.col("w") + F.when(F.col("k") == 2, 1).otherwise(0))

    monkeypatch.setattr(collocations, "_text_counts", lambda *a: passes.append(1) or by_text(*a))
    if shared_hash:
        monkeypatch.setattr(collocations, "_hash_counts", hashes)
    rows = [(lang, f"{a} b c d{i % 3}. e f {a}") for i, (lang, a) in enumerate([("en", "a"), ("fr", "ä"), ("en", "x")] * 40)]
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id int, text string, lang string")
    found = collocations.collocations(docs, least=20, top=50)
    assert sorted(map(tuple, found.collect())) == brute_collocations(rows, 20, 50)
    assert len(passes) == shared_hash


def collocation_rows():
    return [(lang, f"{a} b c d{i % 3}. e f {a}") for i, (lang, a) in enumerate([("en", "a"), ("fr", "ä"), ("en", "x")] * 40)]


def test_frequent_words_are_spelled_without_a_pass_of_their_own(spark, monkeypatch):
    texts, passes = collocations._texts, []
    monkeypatch.setattr(collocations, "_texts", lambda *a: passes.append(1) or texts(*a))
    rows = [(lang, f"{text}. only{i}") for i, (lang, text) in enumerate(collocation_rows())]
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id int, text string, lang string")
    found = collocations.collocations(docs, least=20, top=50, sample_every=1)
    assert sorted(map(tuple, found.collect())) == brute_collocations(rows, 20, 50)
    assert len(passes) == 2  # the sample and the counts


def test_a_rare_word_with_the_hash_of_a_frequent_one_is_noticed(spark, monkeypatch):
    by_text, by_hash = collocations._text_counts, collocations._hash_counts
    passes, h = [], mix(WordHashes().of([b"b"]) ^ collocations._lang_seed("en")).view(np.int64)[0]

    def hashes(*args):
        counted = by_hash(*args)
        if "word" in counted.columns:
            counted = counted.withColumn("h", F.when(F.col("word") == "rare", F.lit(int(h))).otherwise(F.col("h")))
        return counted

    monkeypatch.setattr(collocations, "_text_counts", lambda *a: passes.append(1) or by_text(*a))
    monkeypatch.setattr(collocations, "_hash_counts", hashes)
    rows = [*collocation_rows(), ("en", "rare")]
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id int, text string, lang string")
    found = collocations.collocations(docs, least=20, top=50)
    assert sorted(map(tuple, found.collect())) == brute_collocations(rows, 20, 50)
    assert passes == [1]


# ---- ranked search ----------------------------------------------------------


def brute_search(docs, items, top=50):
    find = lambda t: re.findall("[^\x00-/:-@[-`{-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    rows = [(i, Counter(find(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in rows]
    n_docs, total = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in rows for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for (doc_id, c), n in zip(rows, sizes):
            score = 0
            for t in set(find(text)) & set(c):
                m = 100 - 50 + (50 * n * n_docs) // total
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scores.append((-score, doc_id is not None, doc_id or 0))
        out += [(item_id, rank + 1, d if known else None, -s) for rank, (s, known, d) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=lambda r: (r[0], r[1]))


@pytest.mark.parametrize("block,seeds", [(4096, 16), (32, 2), (256, 1)])
def test_search_against_brute_force(make, spark, monkeypatch, block, seeds):
    monkeypatch.setattr(lexical_search, "BLOCK_DOCS", block)
    monkeypatch.setattr(lexical_search, "SEED_EVERY", seeds)
    rng = random.Random(block)
    vocabulary = [f"T{i}" for i in range(12)] * 5 + ["the", "Of", "naïve", "日本", "a_b"] * 20 + [f"rare{i}" for i in range(200)]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 60)))) for i in range(700)]
    docs += [(None, docs[0][1]), (5, docs[5][1]), (900, None), (901, ""), (902, "!?"), (903, "the " * 20_000), (904, docs[7][1])]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 15)))) for i in range(25)] + [(90, None), (91, "?"), (92, "nowhere"), (93, "the the THE")]
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    rows = lexical_search.search(make(docs), asked, top=7).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted(map(tuple, rows), key=lambda r: (r[0], r[1])) == brute_search(docs, items, 7)
    assert lexical_search.search(make([]), asked).count() == 0
    assert lexical_search.search(make(docs[:3]), asked.limit(0)).count() == 0


def test_a_pair_is_bounded_by_what_a_document_reaches():
    weights = lexical_search.Weights(3, 30, np.array([1000, 1000]))
    row = {"lengths": [10, 10, 10], "term": [0, 1], "df": [2, 2], "at": [0, 1, 1, 2], "tf": [9, 1, 1, 9]}
    block = lexical_search._Block(row, weights)
    assert block.bound((0, 1)) == block.bound((0,)) < block.bound((0,)) + block.bound((1,))


def test_word_hashes_forget_and_stay_equal(monkeypatch):
    monkeypatch.setattr("flowgauge.llm.words.REMEMBERED_BYTES", 1000)
    words = [f"w{i}".encode() for i in range(100)] * 2
    hashes = WordHashes()
    found = hashes.of(words)
    assert (found[:100] == found[100:]).all() and len(hashes) < 100 and len(set(found.tolist())) == 100
