"""Toxicity by weak supervision: voters, a label model, and a linear classifier on its posteriors.

1. Voters. Some are fixed: groups of insults, masked spellings, insults after
   "you". The others are learned: word stems that many toxic texts of a
   bounded sample of labelled rows hold and hardly any clean one does, each
   chosen because it explains texts that no earlier one explains.
2. Every document of the corpus is read once; what is kept of it is the set
   of voters and of candidate stems that it holds.
3. The label model takes the votes of all documents without their labels. It
   estimates by expectation maximisation how often each voter fires in either
   class (drawn to the labelled sample), then the correlations between voters inside the classes, and
   divides the weight of voters that say the same.
4. A logistic regression on stems and voters is trained on the posteriors of
   the sampled documents, and scores every document.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import per_row, text_bytes, values
from flowgauge.llm.held_out import is_held_out, training_labels
from flowgauge.llm.partition_sums import partition_sums
from flowgauge.session import settle

#: Labelled rows of each class that stems are learned from: those with the smallest hash of their id.
SAMPLE = 6000
#: Stems that are considered, and that become voters.
CANDIDATES, LEARNED = 400, 40
#: A stem is considered if it is in so many toxic texts, and if its share among them is so many times that among clean ones.
LEAST_TEXTS, LEAST_RATIO = 3, 20.0
#: A stem becomes a voter if it explains so many texts that no earlier one does.
LEAST_NEW = 2
THRESHOLD = 0.5
STEM_LENGTHS = (4, 5, 6, 7, 8)
ROUNDS = 25

#: Groups of insults; each group is one voter.
LEXICON = (
    "idiot idiots idiotic moron morons moronic imbecile cretin dimwit halfwit dunce",
    "stupid dumb brainless clueless mindless",
    "loser losers failure pathetic worthless useless hopeless",
    "trash garbage scum filth vermin parasite parasites cockroach",
    "disgusting vile revolting repulsive gross nasty ugly",
    "clown clowns joke fool fools jerk jerks creep creeps freak freaks",
    "hate despise loathe",
    "bastard bitch crap asshole",
    "idiota imbécil estúpido estúpida basura asqueroso inútil payaso perdedor",
    "idiot débile stupide imbécile ordure déchet crétin pathétique clown",
    "dummkopf idiot abschaum dreck müll versager widerlich erbärmlich blöd trottel",
)
_MASKED = re.compile(rb"\b(?:id[*1!]ot|st[*u]p[*1!]d|mor[*0]n|l[*0]ser|tr[*@]sh|sc[*]m|b[*]tch|a[*$]{2}hole|f[*]{2}k)", re.I)
_AIMED = re.compile(rb"\byou(?: are|'re)?(?: such)?(?: an?| the)? (?:idiot|moron|loser|clown|fool|jerk|freak|scum|trash|stupid|pathetic|worthless)", re.I)
_WORD = re.compile(rb"[a-z\x80-\xff']+")
FIXED = len(LEXICON) + 2
#: The voter of each word of the lexicon.
WORDS = {w: i for i, group in reversed([*enumerate(LEXICON)]) for w in group.encode().split()}


def words_of(text: bytes) -> set[bytes]:
    """Distinct words with A-Z lowered."""
    return set(_WORD.findall(text.lower()))


def stems_of(words: set[bytes]) -> set[bytes]:
    """The words, and of longer ones the first 4 to 8 characters with a mark."""
    found = set(words)
    for word in words:
        chars = word.decode("utf-8", "replace")
        for n in STEM_LENGTHS:
            if len(chars) > n:
                found.add(chars[:n].encode() + b"-")
    return found


def fixed_votes(text: bytes, words: set[bytes], lexicon: dict[bytes, int]) -> set[int]:
    """Numbers of the fixed voters that fire."""
    votes = {lexicon[w] for w in words & lexicon.keys()}
    if b"*" in text or b"!" in text or b"0" in text or b"1" in text:
        if _MASKED.search(text):
            votes.add(len(LEXICON))
    if b"you" in words and _AIMED.search(text):
        votes.add(len(LEXICON) + 1)
    return votes


def sample_ids(labels: DataFrame, size: int) -> DataFrame:
    """(doc_id, y) of at most ``size`` training rows of each class."""
    rows = training_labels(labels, "toxic").select("doc_id", "y").distinct()
    spread = rows.withColumn("h", F.xxhash64("doc_id"))
    taken = [spread.filter(F.col("y") == y).orderBy("h", "doc_id").limit(size) for y in (1.0, 0.0)]
    return taken[0].unionByName(taken[1]).drop("h")


def stem_counts(sample: DataFrame) -> DataFrame:
    """(stem, toxic, clean): the texts of the sample that hold each stem; counted per task, then added."""

    def run(batches):
        counts = (Counter(), Counter())
        for batch in batches:
            for text, y in zip(values(batch.column(0)), values(batch.column(1))):
                counts[y > 0.5].update(stems_of(words_of(text)))
        clean, toxic = counts
        stems = [s for s in toxic.keys() | clean.keys()]
        for at in range(0, len(stems), 100_000):
            part = stems[at : at + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.binary())] + [pa.array([c[s] for s in part], pa.int64()) for c in (toxic, clean)],
                names=["stem", "toxic", "clean"],
            )

    found = sample.select(text_bytes().alias("text"), "y").mapInArrow(run, "stem binary, toxic bigint, clean bigint")
    return found.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def candidate_stems(counts: DataFrame, n_toxic: int, n_clean: int, most: int = CANDIDATES) -> list[bytes]:
    """The stems with the largest likelihood ratio times texts, at most ``most``."""
    share, other = (F.col("toxic") + 0.5) / (n_toxic + 1), (F.col("clean") + 0.5) / (n_clean + 1)
    found = counts.filter((F.col("toxic") >= LEAST_TEXTS) & (share / other >= LEAST_RATIO))
    order = found.withColumn("gain", F.col("toxic") * F.log(share / other))
    return [bytes(r["stem"]) for r in order.orderBy(F.desc("gain"), "stem").limit(most).collect()]


def usable_lexicon(counts: DataFrame, n_toxic: int, n_clean: int) -> dict[bytes, int]:
    """The lexicon without words that the corpus uses otherwise: clean texts of the sample hold them nearly as often."""
    known = counts.filter(F.col("stem").isin([bytearray(w) for w in WORDS]) & (F.col("clean") > 0)).collect()
    ratio = {bytes(r["stem"]): r["toxic"] * (n_clean + 1) / (r["clean"] * (n_toxic + 1)) for r in known}
    return {w: i for w, i in WORDS.items() if ratio.get(w, LEAST_RATIO) >= LEAST_RATIO}


def choose(holds: np.ndarray, toxic: np.ndarray, explained: np.ndarray, most: int = LEARNED) -> list[int]:
    """Stems (columns) by how many unexplained toxic texts (rows) each one adds, less the clean ones it hits."""
    open_, chosen = toxic & ~explained, []
    clean = (holds & ~toxic[:, None]).sum(axis=0)
    while len(chosen) < most and holds.shape[1]:
        new = (holds & open_[:, None]).sum(axis=0)
        best = int(np.argmax(new - 2 * clean))
        if new[best] < LEAST_NEW or new[best] <= 2 * clean[best]:
            break
        chosen.append(best)
        open_ &= ~holds[:, best]
    return chosen


def hits(docs: DataFrame, lexicon: dict[bytes, int], stems: list[bytes], keep: list[str]) -> DataFrame:
    """``keep`` plus ``fixed`` (voters that fire) and ``held`` (numbers of the stems that a text holds)."""
    number = {s: i for i, s in enumerate(stems)}

    def work(text):
        words = words_of(text)
        held = sorted(number[s] for s in stems_of(words) & number.keys())
        return sorted(fixed_votes(text, words, lexicon)), held

    rows = docs.select(*keep, text_bytes().alias("text"))
    return per_row(rows, work, "fixed array<int>, held array<int>", keep)


def incidence(lists: pa.Array, width: int) -> np.ndarray:
    """0/1 matrix with the listed columns of each row."""
    out = np.zeros((len(lists), width), dtype=bool)
    rows = np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets)))
    out[rows, np.asarray(lists.flatten())] = True
    return out


def vote_matrix(fixed: pa.Array, held: pa.Array, chosen: list[int], stems: int) -> np.ndarray:
    """Votes of a batch: fixed voters, chosen stems, and one voter for clean texts, which fires where no other does."""
    votes = np.hstack([incidence(fixed, FIXED), incidence(held, max(stems, 1))[:, chosen]])
    return np.hstack([votes, ~votes.any(axis=1)[:, None]])


@dataclass
class LabelModel:
    """Log odds of a document: ``bias`` plus, per voter, its weight if it fires and ``off`` if not."""

    prior: float
    fires: np.ndarray  # (class, voter): how often the voter fires
    discount: np.ndarray

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        on = np.log(self.fires[1] / self.fires[0]) * self.discount
        off = np.log((1 - self.fires[1]) / (1 - self.fires[0])) * self.discount
        return np.log(self.prior / (1 - self.prior)) + votes @ (on - off) + off.sum()

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(votes), -30, 30)))


def first_guess(votes: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How often each voter fires in the clean and the toxic part of the sample, drawn to a common guess."""
    guess = np.tile(np.array([[0.01], [0.25]]), (1, votes.shape[1]))
    guess[:, -1] = 0.95, 0.05
    for c, own in enumerate((votes[~y], votes[y])):
        guess[c] = (own.sum(axis=0) + 2 * guess[c]) / (len(own) + 2)
    return guess


def fit_label_model(
    patterns: DataFrame, matrix, fires: np.ndarray, prior: float, rounds: int = ROUNDS
) -> LabelModel:
    """Expectation maximisation on counted vote patterns, then the correlations.

    ``patterns`` has (fixed, held, n); ``matrix`` turns a batch into votes;
    ``fires`` is where the rounds begin.
    """
    voters = fires.shape[1]
    model = LabelModel(prior, fires, np.ones(voters))

    def expected(batch: pa.RecordBatch) -> np.ndarray:
        votes, n = matrix(batch).astype(float), np.asarray(batch.column(2), dtype=float)
        q = model.posterior(votes)
        return np.stack([np.append((n * (1 - q)) @ votes, (n * (1 - q)).sum()), np.append((n * q) @ votes, (n * q).sum())])

    for _ in range(rounds):
        sums = partition_sums(patterns, expected, (2, voters + 1))
        total = sums[:, -1:]
        # halfway to the labelled sample: votes alone can't tell a rare voter that errs from one that doesn't
        updated = 0.5 * (sums[:, :-1] + 2 * fires) / (total + 2) + 0.5 * fires
        changed = float(np.abs(updated - model.fires).max())
        share = float((total[1, 0] + 100 * prior) / (total.sum() + 100))
        model = LabelModel(min(max(share, 1e-4), 0.5), np.clip(updated, 1e-6, 1 - 1e-6), model.discount)
        if changed < 1e-4:
            break

    def within(batch: pa.RecordBatch) -> np.ndarray:
        votes, n = matrix(batch).astype(float), np.asarray(batch.column(2), dtype=float)
        q = model.posterior(votes)
        out = np.zeros((voters, voters))
        for c, p in enumerate((1 - q, q)):
            centred = votes - model.fires[c]
            out += (centred * (n * p)[:, None]).T @ centred
        return out

    covariance = partition_sums(patterns, within, (voters, voters))
    spread = np.sqrt(np.maximum(np.diag(covariance), 1e-12))
    correlation = np.clip(covariance / np.outer(spread, spread), 0, 1)
    np.fill_diagonal(correlation, 0)
    correlation[correlation < 0.1] = 0
    return LabelModel(model.prior, model.fires, 1 / (1 + correlation.sum(axis=1)))


def fit_linear(x: np.ndarray, q: np.ndarray, ridge: float = 1e-4, rounds: int = 40) -> np.ndarray:
    """Logistic regression on soft labels by Newton's method; the first weight is the constant."""
    z = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(z.shape[1])
    penalty = np.full(z.shape[1], ridge * max(len(x), 1))
    penalty[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (p - q) + penalty * w
        curve = (z * (p * (1 - p) + 1e-6)[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 4 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, sample_size: int = SAMPLE, threshold: float = THRESHOLD
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, posterior.

    ``labels`` has doc_id and toxic (1 is toxic); fold 0 of doc_id and rows
    without an id are never learned from. At most ``sample_size`` labelled
    documents of each class are used. Without labels only the fixed voters
    speak. NULL texts count as empty and are scored like any text; repeated
    rows give repeated rows. Other columns are not read.
    """
    ids = settle(sample_ids(labels, sample_size))  # 2 * sample_size rows at most
    sample = settle(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("doc_id", "text", "y"))
    sizes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1.0, 0), sizes.get(0.0, 0)
    stems, lexicon = [], WORDS
    if n_toxic and n_clean:
        counts = settle(stem_counts(sample))
        stems, lexicon = candidate_stems(counts, n_toxic, n_clean), usable_lexicon(counts, n_toxic, n_clean)

    known = hits(sample, lexicon, stems, ["y"]).toArrow()  # as many rows as the sample has
    y = np.asarray(known["y"].combine_chunks()) > 0.5
    fixed, held = known["fixed"].combine_chunks(), known["held"].combine_chunks()
    holds = incidence(held, len(stems)) if len(stems) else np.zeros((len(y), 0), dtype=bool)
    explained = incidence(fixed, FIXED).any(axis=1)
    chosen = choose(holds, y, explained)
    votes = vote_matrix(fixed, held, chosen, len(stems))

    def matrix(batch: pa.RecordBatch) -> np.ndarray:
        return vote_matrix(batch.column(0), batch.column(1), chosen, len(stems))

    own = settle(hits(docs, lexicon, stems, ["doc_id"]))
    patterns = settle(own.groupBy("fixed", "held").agg(F.count(F.lit(1)).alias("n")))
    model = fit_label_model(patterns, matrix, first_guess(votes, y), labelled_share(labels))

    if len(y):
        weights = fit_linear(np.hstack([holds, votes]).astype(float), model.posterior(votes.astype(float)))
    else:
        weights = None
    names, kind = ["doc_id", "score", "posterior"], own.schema["doc_id"].dataType.simpleString()

    def score(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            votes = vote_matrix(batch.column(1), batch.column(2), chosen, len(stems))
            posterior = model.posterior(votes.astype(float))
            found = posterior
            if weights is not None:
                x = np.hstack([incidence(batch.column(2), len(stems)) if stems else votes[:, :0], votes])
                found = 1 / (1 + np.exp(-np.clip(x @ weights[1:] + weights[0], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found), pa.array(posterior)], names=names)

    scored = own.mapInArrow(score, f"doc_id {kind}, score double, posterior double")
    return scored.select(
        "doc_id",
        is_held_out().alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "posterior",
    )


def labelled_share(labels: DataFrame) -> float:
    """Share of toxic rows among the labels that may be learned from."""
    row = training_labels(labels, "toxic").agg(F.avg("y").alias("share")).first()
    return min(max(row["share"] if row["share"] is not None else 0.1, 1e-3), 0.5)
