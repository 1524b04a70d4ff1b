"""Token ids, packing, and token counts from flat files."""

import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import ordered, rows_of
from pyspark.sql import functions as F

from flowgauge.llm import configurations, packing, token_counts, tokens
from flowgauge.llm.common import table
from flowgauge.llm.queries import BYTE_TOKENIZER, WORD_TOKENIZER, vocabulary
from flowgauge.llm.tokens import word_ids

TOKENIZER, RANKS = vocabulary(WORD_TOKENIZER), vocabulary(BYTE_TOKENIZER)
MERGES = []
TEXTS = ["One, two. three", None, "", "   ", "<|endoftext|> <|EndOfText|>", "É́ J̌ ² ½ 日本 it's We'LL", "word " * 9000, "a" * 3000]


def ids_of(text):
    return word_ids(TOKENIZER).tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(list("aAtT'sS.,!  \n\t\x0b\x1c\x85é́ÉİſJ̌<|>0²日_")), st.characters(codec="utf-8")), max_size=60))
def test_ids_are_those_of_the_tokenizer(text):
    found = word_ids(TOKENIZER).ids(text.encode())
    assert list(struct.unpack(f"<{len(found) // 4}I", found)) == ids_of(text)


def test_full_memory_changes_nothing(monkeypatch):
    from flowgauge.llm import tokens

    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    fresh = tokens.WordIds(TOKENIZER)
    for text in ["one two three four five", "one two", "six seven eight one"] * 2:
        assert list(np.frombuffer(fresh.ids(text.encode()), "<u4")) == ids_of(text)
    assert len(fresh.known) <= 3


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abstzé\xdf\xe0\xed\xf7\xffà,.!#$'_-`~^|<>&9", min_size=1, max_size=12))
def test_ids_by_the_merges_alone(text):
    words = tokens.WordIds(TOKENIZER) if not MERGES else MERGES[0]
    MERGES[:] = [words]
    assert words.direct
    assert words._merged(text) in (None, ids_of(text))


def test_plain_words_do_not_pass_the_whole_tokenizer():
    words = tokens.WordIds(TOKENIZER)
    assert all(words._merged(w) == ids_of(w) for w in ["word", "caf\xe9", "\xfcber###", "end.", "x_", "\xff"])
    assert all(words._merged(w) is None for w in ["Word", "it's", "a1", "\xc9", "a\u0301", "12", "#", "a.b"])
    words.tokenizer = None  # would fail if it were asked
    assert list(np.frombuffer(words.ids("Plain words caf\xe9 again%%%".encode()), "<u4")) == ids_of("plain words caf\xe9 again%%%")


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.dictionaries(st.integers(1, 40), st.integers(0, 60), max_size=25))
def test_packing_uses_every_piece_once(capacity, histogram):
    histogram = {size: n for size, n in histogram.items() if size <= capacity}
    used, n = Counter(), 0
    for configuration, times in configurations.pack(histogram, capacity):
        assert times > 0 and sum(size * k for size, k in configuration) <= capacity
        used.update({size: k * times for size, k in configuration})
        n += times
    assert used == Counter({size: k for size, k in histogram.items() if k})
    total = sum(size * k for size, k in histogram.items())
    # never worse than what any fitting rule promises, and at least the tokens need
    assert -(-total // capacity) <= n <= max(1, 2 * total / capacity + 1) if total else n == 0


def test_packing_is_nearly_full():
    lengths = np.clip(np.exp(np.random.default_rng(1).normal(6.5, 1.1, 20_000)).astype(int), 1, 4096)
    packed = configurations.pack(dict(Counter(lengths.tolist())), 4096)
    assert sum(times for _, times in packed) <= 1.001 * lengths.sum() / 4096 + 1


@pytest.mark.parametrize("histogram,capacity,optimum", [
    ({2066: 6000, 1063: 6000, 1043: 6000, 983: 12000}, 4096, 9000),  # no filling reaches 99.95 %
    ({2066: 60000, 1063: 60000, 1043: 60000, 983: 120000}, 4096, 90000),
])
def test_few_lengths_against_the_optimum(histogram, capacity, optimum):
    packed = configurations.pack(histogram, capacity)
    assert sum(times for _, times in packed) <= 1.002 * optimum


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_the_program_packs_documents(spark, folder, monkeypatch):
    """The configuration program is solved for the lengths of documents, and its fillings are those that are used."""
    solve, solved = configurations.fractional, []
    monkeypatch.setattr(configurations, "fractional", lambda *given: solved.append(solve(*given)) or solved[-1])
    texts = [r.text for r in table(spark, f"/root/testdata/{folder}", "documents").select("text").collect()]
    histogram = Counter(min(len(ids_of(t)) + 1, 4096) for t in texts)
    packed = configurations.pack(histogram, 4096)
    volume = -(-sum(size * n for size, n in histogram.items()) // 4096)
    assert len(solved) >= 1 and sum(times for _, times in solved[0]) > 0
    assert volume <= sum(times for _, times in packed) <= 1.001 * volume + 1
    fillings = {c for found in solved for c, _ in found}
    assert sum(times for c, times in packed if c in fillings) >= 0.5 * volume


def test_fractional_solution_covers_no_more_than_there_is():
    sizes, counts = np.array([7, 5, 4, 3]), np.array([10, 20, 30, 40])
    covered = Counter()
    for configuration, times in configurations.fractional(sizes, counts, 12):
        covered.update({size: k * times for size, k in configuration})
    assert all(covered[s] <= n + 1e-6 for s, n in zip(sizes.tolist(), counts.tolist()))


def test_lengths_beyond_the_capacity_are_refused():
    with pytest.raises(ValueError):
        configurations.pack({5: 1}, 4)


def check_packing(rows, found, capacity):
    wanted = []
    for i, text in rows:
        ids = [*ids_of(text), packing.END_ID]
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            wanted.append((i, n, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    assert rows_of(found, "doc_id", "piece", "start", "length", "ids_crc32") == ordered(wanted)
    places = defaultdict(list)
    for r in found.collect():
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= capacity
    return len(places)


@pytest.mark.parametrize("capacity", [7, 4096])
def test_packed_documents(make, capacity):
    rows = list(enumerate(TEXTS)) + [(2, ""), (None, "nobody"), (20, TEXTS[0]), (21, TEXTS[0])]
    found = packing.best_fit_packing(make(rows), TOKENIZER, capacity).cache()
    check_packing(rows, found, capacity)
    with_ids = packing.best_fit_packing(make(rows), TOKENIZER, capacity, with_ids=True).collect()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in with_ids)
    assert packing.best_fit_packing(make([]), TOKENIZER, capacity).count() == 0


def test_whole_table_is_packed_tightly(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = packing.best_fit_packing(docs, TOKENIZER).cache()
    used = check_packing(rows, found, 4096)
    assert used <= 1.002 * found.agg(F.sum("length")).first()[0] / 4096 + 1


@pytest.mark.parametrize("most", [1, 10, 1000])
def test_ranks_of_a_hot_length(spark, most):
    rows = [(i, 0, 5 if i % 3 else 9, i) for i in range(300)] + [(7, 0, 5, 7)] * 4
    found = spark.createDataFrame(rows, "doc_id bigint, piece int, length bigint, ids_crc32 bigint")
    ranks = defaultdict(list)
    for r in packing.ranked(found, dict(Counter(r[2] for r in rows)), most).collect():
        ranks[r.length].append(r.rank)
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in Counter(r[2] for r in rows).items()}


def plain_counts(rows):
    encode = token_counts.encoding(RANKS).encode_ordinary
    return ordered((i, len(encode(t or ""))) for i, t in rows)


@pytest.mark.parametrize("block_ids", [1, 7, 1 << 16])
def test_token_counts(make, block_ids):
    rows = list(enumerate(TEXTS[:6] + ["long " * 300])) + [(2, ""), (None, "nobody"), (30, "<|endoftext|>")]
    found = token_counts.token_counts(make(rows), RANKS, block_ids=block_ids)
    assert rows_of(found, "doc_id", "n_tokens") == plain_counts(rows)
    assert token_counts.token_counts(make([]), RANKS, block_ids=block_ids).count() == 0


def test_token_counts_of_a_whole_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert rows_of(token_counts.token_counts(docs, RANKS), "doc_id", "n_tokens") == plain_counts(rows)


@pytest.mark.parametrize("id_bytes", [2, 4])
def test_separators_of_any_flat_file(spark, id_bytes):
    rng = random.Random(id_bytes)
    rows, wanted = [], []
    for file in range(6):
        ids = [rng.choice([9, 9, 0, 0, 0, 1, 2]) for _ in range(rng.randint(0, 60))]
        if file == 0:
            ids = [0] * 30  # no separator at all
        raw, n = struct.pack(f"<{len(ids)}{'H' if id_bytes == 2 else 'I'}", *ids), 0
        rows += [(file, b, bytearray(raw[at : at + 5 * id_bytes])) for b, at in enumerate(range(0, len(raw), 5 * id_bytes))]
        rows += [(file, 100, bytearray())] * (file % 2)
        parts = []
        for i in ids:
            if i == 9:
                parts, n = parts + [n], 0
            else:
                n += 1
        parts += [n] * (n > 0)
        wanted += [(file, k, length) for k, length in enumerate(parts)]
    blocks = spark.createDataFrame(rows, "file int, block bigint, ids binary").repartition(4)
    assert rows_of(token_counts.count_tokens(blocks, 9, id_bytes), "file", "ordinal", "n_tokens") == ordered(wanted)


def test_wide_separator_is_refused(make):
    with pytest.raises(ValueError):
        token_counts.write_flat(make([(1, "x")]), RANKS, separator=1 << 16)


@pytest.mark.parametrize("kind", ["int", "string", "smallint"])
def test_token_counts_with_ids_of_other_types(spark, kind):
    rows = spark.createDataFrame([(1, "some words"), (2, None), (3, "x " * 500), (None, "")], "doc_id bigint, text string")
    plain = {r.doc_id: r.n_tokens for r in token_counts.token_counts(rows, vocabulary(BYTE_TOKENIZER)).collect()}
    other = token_counts.token_counts(rows.withColumn("doc_id", rows.doc_id.cast(kind)), vocabulary(BYTE_TOKENIZER))
    assert dict(other.dtypes)["doc_id"] == kind
    assert {r.doc_id and int(r.doc_id): r.n_tokens for r in other.collect()} == plain
