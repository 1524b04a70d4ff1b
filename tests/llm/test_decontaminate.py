"""Leaks of benchmark items, verbatim and with other numbers, names and units."""

import random
import re
from collections import Counter

import pytest
from llm_helpers import rows_of

from flowgauge.llm import decontaminate
from flowgauge.llm.common import table

QUESTION = (
    "The farmer said that Alice sold 12 boxes of red apples for 30 dollars and then Alice gave 12 smaller boxes "
    "to Robert, who paid 7 dollars more."
)
CHANGED = QUESTION.replace("Alice", "Maria").replace("Robert", "Peter").replace("12", "48").replace("30", "95").replace("dollars", "euros").replace("7", "3")
MIXED = QUESTION.replace("Alice sold 12", "Maria sold 48").replace("30", "31")  # Alice is Maria once and Alice once
FILLER = "some words that stand here before the question and have nothing to do with it"


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [
        (1, QUESTION),
        (2, "1 2 3 4 5 6 7 8 9 10 11 12"),
        (3, "two words"),
        (4, None),
        (5, ""),
        (1, QUESTION),
        (6, "plain items are found whatever the case and the signs between their words may be"),
    ]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def found(make, benchmark, texts):
    rows = list(enumerate(texts))
    return {(r.doc_id, r.item_id) for r in decontaminate.leaks(make(rows), benchmark).collect()}


def test_what_is_found(make, benchmark):
    texts = [
        f"{FILLER}\n{QUESTION}\n{FILLER}",
        f"{FILLER}. {CHANGED} {FILLER}",
        MIXED,
        "1 2 3 4 5 6 7 8 9 10 11 12",
        "21 22 23 24 25 26 27 28 29 30 31 32",
        "Two  words!",
        "two words more",
        None,
        "",
        "PLAIN items, are: found - whatever the CASE and the signs between their words may be!!",
        "plain items are found whatever the case and the signs stand somewhere else here",
        " ".join([FILLER] * 8000) + " " + QUESTION,
        f"{QUESTION} {CHANGED}",
        " ".join(QUESTION.split()[: len(QUESTION.split()) // 2]),
    ]
    assert found(make, benchmark, texts) == {(0, 1), (1, 1), (3, 2), (5, 3), (9, 6), (11, 1), (12, 1)}


def test_share_of_windows(make, benchmark):
    words = "plain items are found whatever the case and the signs between their words may be".split()
    assert len(words) == 15  # 11 windows, of which 9 are needed
    assert found(make, benchmark, [" ".join([*words[:13], "x", "y"]), " ".join([*words[:12], "x", "y"])]) == {(0, 6)}


def test_rows_without_id_and_repeated_rows(make, benchmark):
    rows = [(None, QUESTION), (None, FILLER), (7, QUESTION), (7, QUESTION), (8, FILLER), (7, FILLER)]
    docs = make(rows)
    kept = decontaminate.remove_leaks(docs, benchmark)
    assert kept.columns == docs.columns
    assert rows_of(kept, "doc_id", "text") == [(None, FILLER), (7, FILLER), (8, FILLER)]
    assert rows_of(decontaminate.leaks(docs, benchmark), "doc_id", "item_id") == [(None, 1), (7, 1)]


def test_no_rows(make, benchmark):
    assert decontaminate.leaks(make([]), benchmark).count() == 0
    assert decontaminate.leaks(make([(1, QUESTION)]), benchmark.filter("item_id < 0")).count() == 0
    assert decontaminate.remove_leaks(make([(1, QUESTION)]), benchmark.filter("item_id < 0")).count() == 1


def test_blocks_of_items_change_nothing(make, benchmark, monkeypatch):
    rows = [(0, QUESTION), (1, CHANGED), (2, "two words")]
    one = rows_of(decontaminate.leaks(make(rows), benchmark), "doc_id", "item_id", "n_found")
    monkeypatch.setattr(decontaminate, "BLOCK_ROWS", 10)
    assert rows_of(decontaminate.leaks(make(rows), benchmark), "doc_id", "item_id", "n_found") == one


UNIT = "|".join(sorted(decontaminate.UNITS, key=len, reverse=True))


def brute_words(text):
    """(kind, word) of a text by a scan, one word after the other; numbers have a point wherever one stands."""
    out = []
    for m in re.finditer(r"[0-9]+(?:[.,][0-9]+)*|[^\W\d_]+", text or ""):
        word, before = m[0], text[: m.start()]
        if word[0].isdigit():
            out.append(("#", word.replace(",", ".")))
        elif out and out[-1][0] == "#" and re.search(r"[0-9] ?$", before) and re.fullmatch(UNIT, word.lower()):
            out.append(("u", word.lower()))
        elif re.match(r"[A-ZÀ-Ý][a-zß-ÿ]", word) and re.search(r"[a-zß-ÿ0-9,;:] $", before):
            out.append(("n", word.lower()))
        else:
            out.append(("w", word.lower()))
    return out


def brute_item(text):
    """(word, kind, key) of an item's words: a word seen as a name is one everywhere, a number's key holds its unit."""
    words = brute_words(text)
    names = {w for kind, w in words if kind == "n"}
    out = []
    for i, (kind, word) in enumerate(words):
        kind = kind if kind in "#u" else "n" if word in names else "w"
        unit = words[i + 1] if kind == "#" and words[i + 1 : i + 2] and words[i + 1][0] == "u" else None
        out.append((word, kind, None if kind == "w" else (kind, word, unit)))
    return out


def brute_covered(item, doc, shift, size, needed):
    """Windows of the item that its alignment with the document covers."""
    spots, votes = [], {}
    for i, (word, kind, key) in enumerate(item):
        other, value = doc[i + shift] if 0 <= i + shift < len(doc) else (None, None)
        same = value == word
        fits = same or (other == kind if kind in "#u" else kind == "n" and other in ("w", "n"))
        spots.append((key, value, same, fits))
        if key and fits:
            votes.setdefault(key, Counter())[(same, value)] += 1
    best = {key: max((n, same, value) for (same, value), n in found.items())[2] for key, found in votes.items()}
    literal, agrees, leads = set(), set(), False
    for i in range(max(1, len(item) - size + 1)):
        part = spots[i : i + size]
        if all(same for _, _, same, _ in part):
            literal.add(i)
        if all(fits and (key is None or best[key] == value) for key, value, _, fits in part):
            agrees.add(i)
            leads |= sum(key is None for key, *_ in part) >= needed
    return literal | agrees if leads else literal


def brute_leaks(docs, items, size=5):
    out = set()
    described = [(i, brute_item(text)) for i, text in items]
    for doc_id, text in docs:
        doc, at = brute_words(text), {}
        for p, (_, word) in enumerate(doc):
            at.setdefault(word, []).append(p)
        for item_id, item in described:
            if not item or (len(item) < size and len(doc) != len(item)):
                continue
            n = max(1, len(item) - size + 1)
            plain = max(sum(key is None for *_, key in item[i : i + size]) for i in range(n))
            needed = 2 if plain >= 2 else 1
            shifts = Counter(p - i for i, (word, *_) in enumerate(item) for p in at.get(word, ()))
            covered = set()
            for shift, equal in shifts.items():
                if equal >= needed:
                    covered |= brute_covered(item, doc, shift, size, needed)
            if len(covered) >= 0.8 * n - 1e-9:
                out.add((doc_id, item_id, n, len(covered)))
    return out


def test_against_brute_force(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    rng = random.Random(2)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    item_rows = [tuple(r) for r in items.collect()]
    made = [(10_000 + i, f"{rng.choice(rows)[1]} {t} 12 km with Anna, 3.5 kg") for i, t in item_rows]
    both = spark.createDataFrame(rows + made, "doc_id bigint, text string")
    wanted = brute_leaks(rows + made, item_rows)
    assert set(rows_of(decontaminate.leaks(both, items), "doc_id", "item_id", "n_windows", "n_found")) == wanted
    assert {i for i, *_ in wanted} >= {i for i, _ in made}


APPLES = "Alice has 3 apples. Alice buys 4 more apples than Bob. How many apples does Alice have now?"
SUM = "What is 23 + 45 + 67 + 89 + 12 and 34?"
NOUNS = "Der alte Mann kauft im Laden drei Brote und trägt die Taschen mit dem Hund nach Hause zur Familie."


def test_names_and_numbers_wherever_they_stand(make, spark):
    items = spark.createDataFrame([(1, APPLES), (2, SUM), (3, NOUNS), (4, "1 2 3 4 5 6 7 8")], "item_id bigint, text string")
    changed = APPLES.replace("Alice", "Maria").replace("Bob", "Peter").replace("3", "8").replace("4", "15")
    texts = [changed, f"{FILLER} {changed}", changed.lower(), APPLES.upper(), NOUNS.lower(), NOUNS.upper(),
             "What is 71 + 82 + 93 + 14 + 25 and 36?", "1 2 3 4 5 91 92 93", FILLER]
    assert found(make, items, texts) == {(0, 1), (1, 1), (2, 1), (3, 1), (4, 3), (5, 3), (6, 2)}


def test_a_window_that_items_share_and_a_document_repeats(make, spark):
    rows = [(i, f"what is the value of alpha{'abcdefgh'[i % 8]} under beta{'abcdefgh'[i // 8]} seen by the old gate") for i in range(64)]
    items = spark.createDataFrame(rows, "item_id bigint, text string")
    repeats = " ".join(f"what is the value of {'xyz'[k % 3] * (2 + k % 5)} near" for k in range(300))
    shared = decontaminate.leaks(make([(1, repeats), (None, repeats), (2, f"{repeats} {rows[9][1]}"), (3, FILLER)]), items).collect()
    n_windows = len(rows[9][1].split()) - 4
    assert {(r.doc_id, r.item_id, r.n_found, r.n_windows) for r in shared} == {(2, 9, n_windows, n_windows)}


def test_alignments_carry_no_words(make, benchmark):
    texts = decontaminate.item_words(benchmark).dropDuplicates(["item_key"])
    found = decontaminate.alignments(make([(1, f"{QUESTION} {QUESTION}")] * 3), decontaminate.item_windows(texts))
    assert found.columns == ["doc", "item_key", "length", "shift"]
    assert found.count() == found.distinct().count() <= 20


def test_slots_that_disagree_cost_only_their_windows(make, spark):
    items = spark.createDataFrame([(1, QUESTION), (2, TRAVEL), (3, PAY)], "item_id bigint, text string")
    one_altered = QUESTION.replace("gave 12", "gave 13")  # 5 of 24 windows differ, the others are the same
    coincide = QUESTION.replace("12", "5").replace("30", "5").replace("7", "5")
    rows = {r.doc_id: r for r in decontaminate.leaks(make(list(enumerate([one_altered, coincide, TRAVEL_2, PAY_2]))), items).collect()}
    assert {(i, r.item_id, r.n_found) for i, r in rows.items()} == {(1, 1, 24), (2, 2, rows[2].n_windows), (3, 3, rows[3].n_windows - 5)}


TRAVEL = "The red train needs 60 km in 60 minutes and then it waits until the next signal shows green."
TRAVEL_2 = TRAVEL.replace("60 km", "90 km").replace("60 minutes", "45 minutes")
PAY = (
    "A man pays 12 coins for bread at the old market and walks home with his dog along the river until he meets his "
    "neighbour who gave him 12 pears and a basket of nuts from the garden behind the small white house."
)
PAY_2 = PAY.replace("12 pears", "13 pears")
