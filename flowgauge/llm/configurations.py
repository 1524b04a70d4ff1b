"""Bin packing of a length histogram by its configuration linear program.

The program has a variable for every way to fill a sequence (a configuration)
and a row for every length: the chosen configurations must cover all pieces of
that length. It is solved by multiplicative weights. A length's price is its
share of a sequence times a weight that shrinks by ``exp(-STEP * covered
share)``; pricing is a knapsack by dynamic programming over a random choice of
lengths, and the best configuration is used for a share of what its scarcest
length still needs. Where no random choice fills a sequence, all lengths are
priced and the best configuration is used as it is, until every need is covered
or best-fit packs the rest about as well as its tokens allow. The solution is rounded up as long as pieces last; what
remains is packed best-fit, largest first, by counts.

All of it works on the histogram, so its size is bounded by the capacity and
not by the number of pieces.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections import Counter

import numpy as np

#: Share of the scarcest length's pieces that one configuration takes in a round.
SHARE = 0.25
#: The same in smaller steps, tried where the sequences stay above what the tokens need.
SMALL_SHARE = 0.03
#: Exponent of the weights, by covered share.
STEP = 4.0
#: Lengths that one pricing looks at.
PRICED = 160
#: The rounds end here at the latest, and the pieces left are packed best-fit.
ROUNDS = 4_000
#: A configuration of a random choice is used if it fills so much; after ``MISSES`` rounds in a row without one all lengths are priced.
LEAST_FILL = 0.9995
MISSES = 20

Configuration = tuple[tuple[int, int], ...]  # (length, copies), longest first


def best_configuration(lengths: np.ndarray, prices: np.ndarray, most: np.ndarray, capacity: int) -> dict[int, int]:
    """Knapsack: index -> copies of the most valuable filling, with at most ``most`` copies of each."""
    items = []
    for i, (size, top) in enumerate(zip(lengths.tolist(), most.tolist())):
        left, k = min(top, capacity // size), 1
        while left > 0:
            k = min(k, left)
            items.append((i, k, size * k))
            left, k = left - k, 2 * k
    value = np.zeros(capacity + 1)
    taken = np.zeros((len(items), capacity + 1), dtype=bool)
    for row, (i, k, size) in enumerate(items):
        better = value[:-size] + prices[i] * k
        np.greater(better, value[size:], out=taken[row, size:])
        np.maximum(value[size:], better, out=value[size:])
    chosen, room = Counter(), capacity
    for row in range(len(items) - 1, -1, -1):
        if taken[row, room]:
            i, k, size = items[row]
            chosen[i] += k
            room -= size
    return chosen


def fractional(
    lengths: np.ndarray, counts: np.ndarray, capacity: int, share: float = SHARE, patient: bool = True
) -> list[tuple[Configuration, float]]:
    """A cover of the histogram by configurations with fractional multiplicities; partial if it isn't ``patient``."""
    rng = np.random.default_rng(len(lengths))
    need, weight = counts.astype(float), np.ones(len(lengths))
    found: list[tuple[Configuration, float]] = []
    missed, whole = 0, False
    for _ in range(ROUNDS):
        open_ = np.flatnonzero(need > 1e-9)
        if not len(open_):
            break
        if len(open_) > PRICED and not whole:  # lengths with more left to pack are looked at more often
            mass = need[open_] * lengths[open_]
            open_ = np.sort(rng.choice(open_, PRICED, replace=False, p=mass / mass.sum()))
        prices = lengths[open_] / capacity * weight[open_]
        most = np.ceil(need[open_]).astype(np.int64)
        chosen = best_configuration(lengths[open_], prices, most, capacity)
        rows = {int(open_[i]): k for i, k in chosen.items()}
        fill = sum(int(lengths[i]) * k for i, k in rows.items())
        if not whole and fill < LEAST_FILL * capacity:
            missed += 1
            if missed == MISSES:
                if not patient or nearly_full(lengths, counts, need, capacity):
                    break
                whole = True
            continue
        missed = 0
        times = min(max(share * counts[i], 1.0) / k for i, k in rows.items())
        times = min(times, min(max(need[i], 1e-9) / k for i, k in rows.items()))
        for i, k in rows.items():
            need[i] = max(0.0, need[i] - k * times)
            weight[i] *= math.exp(-STEP * k * times / counts[i])
        found.append((tuple(sorted(((int(lengths[i]), k) for i, k in rows.items()), reverse=True)), times))
    return found


def nearly_full(lengths: np.ndarray, counts: np.ndarray, need: np.ndarray, capacity: int) -> bool:
    """Whether best-fit packs what is needed with no more waste, next to all sequences, than ``LEAST_FILL`` allows."""
    left = {int(size): int(n) for size, n in zip(lengths, np.ceil(need - 1e-6)) if n > 0}
    used = sum(times for _, times in best_fit(left, capacity))
    least = math.ceil(sum(size * n for size, n in left.items()) / capacity)
    return used - least <= max(0.0, (1 - LEAST_FILL) * int(lengths @ counts) / capacity)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Configuration, int]]:
    """Best-fit decreasing on counts: equal sequences are filled together."""
    rooms: list[int] = []  # sorted distinct free rooms
    open_: dict[int, list[tuple[Counter, int]]] = {}

    def put(content: Counter, times: int, room: int) -> None:
        if room not in open_:
            insort(rooms, room)
            open_[room] = []
        open_[room].append((content, times))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left > 0:
            at = bisect_left(rooms, size)
            if at == len(rooms):
                each = min(capacity // size, left)
                put(Counter({size: each}), left // each, capacity - each * size)
                left -= left // each * each
                continue
            room = rooms[at]
            content, times = open_[room].pop()
            if not open_[room]:
                del open_[room], rooms[at]
            each = min(room // size, max(1, left // times))
            used = min(times, left // each)
            if used < times:
                put(content, times - used, room)
            put(content + Counter({size: each}), used, room - each * size)
            left -= used * each
    done = [(tuple(sorted(content.items(), reverse=True)), n) for x in open_.values() for content, n in x]
    return sorted(done)


def pack(histogram: dict[int, int], capacity: int) -> list[tuple[Configuration, int]]:
    """length -> count to [(configuration, times)], using every piece exactly once.

    The program is always solved. Plain best-fit takes its place only if it
    needs fewer sequences; longer rounds follow while the better of both stays
    above what the tokens need.
    """
    left = {size: n for size, n in histogram.items() if n > 0}
    if any(not 0 < size <= capacity for size in left):
        raise ValueError(f"lengths are from 1 to {capacity}")
    packed: Counter = Counter()
    if capacity in left:
        packed[((capacity, 1),)] = left.pop(capacity)
    sizes = np.array(sorted(left, reverse=True), dtype=np.int64)
    counts = np.array([left[s] for s in sizes.tolist()], dtype=np.int64)
    least = sum(size * n for size, n in left.items()) / capacity
    enough = math.ceil(least) + (1 - LEAST_FILL) * least
    ways: list[Counter] = []
    plain = rounded(left, [], capacity)
    for share, patient in ((SHARE, False), (SHARE, True), (SMALL_SHARE, True)):
        ways.append(rounded(left, fractional(sizes, counts, capacity, share, patient), capacity))
        best = min(*ways, plain, key=lambda way: sum(way.values()))
        if sum(best.values()) <= enough:
            break
    packed.update(best)
    return list(packed.items())


def rounded(pieces: dict[int, int], solution: list[tuple[Configuration, float]], capacity: int) -> Counter:
    """The solution rounded up as long as pieces last, and the rest best-fit."""
    left, packed = dict(pieces), Counter()
    for configuration, times in solution:
        whole = min(math.ceil(times - 1e-6), *(left[size] // k for size, k in configuration), math.inf)
        if whole > 0:
            packed[configuration] += whole
            for size, k in configuration:
                left[size] -= whole * k
    for configuration, times in best_fit({s: n for s, n in left.items() if n}, capacity):
        packed[configuration] += times
    return packed
