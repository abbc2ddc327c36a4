"""String comparators as Arrow functions over two aligned columns, and the registry that features are made from.

Scale 0 to 100 but for jaro_winkler (0 to 1). Two empty strings are equal (100) for ratio, partial and sorted words; word sets and the
weighted blend are 0 if either string has no word. Null in, null out. Equal strings are not compared, nor is a pair a second
time that a batch repeats.

A batch is compared as a whole (pairloom.functions.lcs): windows of all pairs are combed together, and pairs whose shorter string fits a machine
word go through bit-parallel steps as columns of words. The functions of single pairs here do the longer ones, and state what a batch must give.
Comparators of the same columns are made together (compare_many), so that none is made twice.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from pairloom.functions import lcs


@lru_cache(maxsize=64)
def _places(a: str) -> dict[str, int]:
    """The places of each character of a, as bits. Neighbouring pairs often share a string."""
    if len(a) > 256:
        codes = np.frombuffer(a.encode("utf-32-le", "surrogatepass"), np.uint32)
        return {c: int.from_bytes(np.packbits(codes == ord(c), bitorder="little").tobytes(), "little") for c in set(a)}
    at: dict[str, list[int]] = {}
    for i, c in enumerate(a):
        at.setdefault(c, []).append(i)
    return {c: sum(1 << i for i in places) for c, places in at.items()}


def _lcs_steps(at: dict[str, int], m: int, b: str) -> Iterator[int]:
    """Length of the longest common subsequence with each beginning of b, the empty one left out; one big-integer step for each."""
    state = full = (1 << m) - 1
    for c in b:
        u = state & at.get(c, 0)
        state = (state + u | state - u) & full
        yield m - state.bit_count()


def _lcs(at: dict[str, int], m: int, b: str) -> int:
    state = full = (1 << m) - 1
    get = at.get
    for c in b:
        if u := state & get(c, 0):
            state = (state + u | state - u) & full
    return m - state.bit_count()


def _shared_beginning(a: str, b: str) -> int:
    """How many characters two strings share from their beginning on."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle - 1)
    return low


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, one big-integer step for each character of the shorter string."""
    if len(a) < len(b):
        a, b = b, a
    first = _shared_beginning(a, b)
    last = _shared_beginning(a[first:][::-1], b[first:][::-1])
    if 2 * (first + last) > len(b):
        return first + last + _lcs(_places(x := a[first : len(a) - last]), len(x), b[first : len(b) - last])
    return _lcs(_places(a), len(a), b)


def ratio(a: str, b: str) -> float:
    """Normalised indel similarity: 200 * LCS / (len a + len b)."""
    if a == b:
        return 100.0
    return 200.0 * lcs_length(a, b) / (len(a) + len(b))


def partial(a: str, b: str) -> float:
    """Best ratio of the shorter string with a window of the longer one; windows at the ends may be shorter."""
    if a == b:
        return 100.0
    if not a or not b:
        return 0.0
    if len(a) == len(b):
        return max(_windows(a, b), _windows(b, a))
    return _windows(a, b) if len(a) < len(b) else _windows(b, a)


def _windows(short: str, long: str) -> float:
    m, n = len(short), len(long)
    at = _places(short)
    # Windows at the left end are beginnings of the longer string, those at the right end are its endings: one pass for each side.
    best = max(200.0 * k / (m + w) for w, k in enumerate(_lcs_steps(at, m, long[:m]), 1))
    best = max(best, *(200.0 * k / (m + w) for w, k in enumerate(_lcs_steps(_places(short[::-1]), m, long[: n - m - 1 if n > m else None : -1]), 1)))
    start = 0
    while start + m <= n:
        k = _lcs(at, m, long[start : start + m])
        best = max(best, 200.0 * k / (m + m))
        # a window that is j places on has at most k + j in common: go to the first one that can be better
        start += max(1, int(best * m / 100.0 + 1e-9) - k + 1)
    return best


def _sorted(text: str) -> str:
    return " ".join(sorted(text.split()))


def token_sort(a: str, b: str) -> float:
    return ratio(_sorted(a), _sorted(b))


def _sets(a: str, b: str) -> tuple[str, str, str]:
    x, y = set(a.split()), set(b.split())
    return " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))


def token_set(a: str, b: str) -> float:
    if not a.split() or not b.split():
        return 0.0
    both, left, right = _sets(a, b)
    if both and not (left and right):
        return 100.0
    x, y = f"{both} {left}".strip(), f"{both} {right}".strip()
    return max(ratio(x, y), ratio(both, x) if both else 0.0, ratio(both, y) if both else 0.0)


def partial_token(a: str, b: str) -> float:
    """The better of the partial ratios of sorted words and of words that only one string has."""
    both, left, right = _sets(a, b)
    if both:
        return 100.0
    return max(partial(_sorted(a), _sorted(b)), partial(left, right))


def weighted(a: str, b: str) -> float:
    """Blend by the ratio of lengths: whole strings below 1.5, windows above."""
    if not a or not b:
        return 0.0
    longer = max(len(a), len(b)) / min(len(a), len(b))
    if longer < 1.5:
        return max(ratio(a, b), 0.95 * max(token_sort(a, b), token_set(a, b)))
    scale = 0.9 if longer <= 8 else 0.6
    return max(ratio(a, b), scale * partial(a, b), 0.95 * scale * partial_token(a, b))


def jaro_winkler(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken, matched = [False] * len(b), []
    places: dict[str, deque[int]] = {}
    for j, c in enumerate(b):
        places.setdefault(c, deque()).append(j)
    for i, c in enumerate(a):
        free = places.get(c)
        while free and free[0] < i - reach:  # no later character reaches back to it either
            free.popleft()
        if free and free[0] <= i + reach:
            taken[free.popleft()] = True
            matched.append(c)
    if not matched:
        return 0.0
    m = len(matched)
    moved = sum(x != y for x, y in zip(matched, (b[j] for j in range(len(b)) if taken[j]))) // 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    prefix = 0
    while prefix < min(4, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + 0.1 * prefix * (1 - jaro) if jaro > 0.7 else jaro


# -- batches ---------------------------------------------------------------------------------------------------------------------------

Pairs = tuple[list[str], list[str]]


def _where(todo: np.ndarray, value: np.ndarray, compare: Callable[[list[str], list[str]], np.ndarray], a: list[str], b: list[str]) -> np.ndarray:
    """`value` with what `compare` gives where `todo` holds."""
    rows = np.flatnonzero(todo)
    if len(rows):
        value[rows] = compare([a[i] for i in rows], [b[i] for i in rows])
    return value


def _equal(a: list[str], b: list[str]) -> np.ndarray:
    return np.fromiter((x == y for x, y in zip(a, b)), bool, len(a))


def _sizes(a: list[str]) -> np.ndarray:
    return np.fromiter(map(len, a), np.int64, len(a))


def ratio_many(a: list[str], b: list[str]) -> np.ndarray:
    compare = lambda x, y: 200.0 * lcs.lengths(x, y, lcs_length) / np.maximum(_sizes(x) + _sizes(y), 1)
    return _where(~_equal(a, b), np.full(len(a), 100.0), compare, a, b)


def partial_and_ratio(a: list[str], b: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """partial() and ratio() of all pairs, from one pass."""
    same = _equal(a, b)
    partial, ratio = np.where(same, 100.0, 0.0), np.where(same, 100.0, 0.0)
    rows = [i for i in np.flatnonzero(~same).tolist() if a[i] and b[i]]
    if rows:
        pairs = [(a[i], b[i]) if len(a[i]) <= len(b[i]) else (b[i], a[i]) for i in rows]
        short, long = [x for x, _ in pairs], [y for _, y in pairs]
        m, n = _sizes(short), _sizes(long)
        found, common = lcs.best_windows(short, long)
        # Strings of one length take windows of either.
        partial[rows] = np.maximum(found, _where(m == n, np.zeros(len(rows)), lambda x, y: lcs.best_windows(x, y)[0], long, short))
        ratio[rows] = 200.0 * common / (m + n)
    return partial, ratio


def partial_many(a: list[str], b: list[str]) -> np.ndarray:
    return partial_and_ratio(a, b)[0]


def token_sort_many(a: list[str], b: list[str]) -> np.ndarray:
    return ratio_many(list(map(_sorted, a)), list(map(_sorted, b)))


def token_set_many(a: list[str], b: list[str]) -> np.ndarray:
    value = np.zeros(len(a))
    parts = [_sets(x, y) if x.split() and y.split() else None for x, y in zip(a, b)]
    for i, part in enumerate(parts):
        if part and part[0] and not (part[1] and part[2]):
            value[i] = 100.0
    rows = [i for i, part in enumerate(parts) if part and value[i] == 0.0]
    if rows:
        both, left, right = (_sizes([parts[i][k] for i in rows]) for k in range(3))
        # Shared words are a beginning of either side, and what follows is compared.
        ahead = both + (both > 0)
        common = lcs.lengths([parts[i][1] for i in rows], [parts[i][2] for i in rows], lcs_length)
        found = 200.0 * (ahead + common) / (2 * ahead + left + right)
        for side in (left, right):
            found = np.maximum(found, 200.0 * both / (both + ahead + side))
        value[rows] = found
    return value


def partial_token_many(a: list[str], b: list[str]) -> np.ndarray:
    parts = [_sets(x, y) for x, y in zip(a, b)]
    apart = np.fromiter((not part[0] for part in parts), bool, len(parts))

    def compare(x: list[str], y: list[str]) -> np.ndarray:
        rest = [_sets(p, q) for p, q in zip(x, y)]
        return np.maximum(partial_many(list(map(_sorted, x)), list(map(_sorted, y))), partial_many([r[1] for r in rest], [r[2] for r in rest]))

    return _where(apart, np.full(len(a), 100.0), compare, a, b)


def weighted_many(a: list[str], b: list[str], known: dict[str, np.ndarray] | None = None) -> np.ndarray:
    """known: what other comparators have given for these pairs."""
    known = known or {}
    m, n = _sizes(a), _sizes(b)
    short = np.minimum(m, n)
    longer = np.maximum(m, n) / np.maximum(short, 1)
    value = np.zeros(len(a))
    for todo, scale in (((short > 0) & (longer < 1.5), None), ((longer >= 1.5) & (longer <= 8), 0.9), (longer > 8, 0.6)):
        rows = np.flatnonzero(todo & (short > 0))
        if not len(rows):
            continue
        x, y = [a[i] for i in rows], [b[i] for i in rows]
        of = lambda kind: known[kind][rows] if kind in known else COMPARATORS[kind](x, y)
        if scale is None:
            value[rows] = np.maximum(of("ratio"), 0.95 * np.maximum(of("token_sort"), of("token_set")))
        else:
            value[rows] = np.maximum(of("ratio"), np.maximum(scale * of("partial"), 0.95 * scale * partial_token_many(x, y)))
    return value


def compare_many(kinds: list[str], a: list[str], b: list[str]) -> dict[str, np.ndarray]:
    """Several comparators of the same pairs: what one has given is not made again for another."""
    made: dict[str, np.ndarray] = {}
    if "partial" in kinds:
        made["partial"], made["ratio"] = partial_and_ratio(a, b)
    for kind in sorted(set(kinds) - set(made), key="weighted".__eq__):  # the blend last
        made[kind] = weighted_many(a, b, made) if kind == "weighted" else COMPARATORS[kind](a, b)
    return {kind: made[kind] for kind in kinds}


def jaro_winkler_many(a: list[str], b: list[str]) -> np.ndarray:
    return lcs.jaro_winkler(a, b, jaro_winkler)


def _distinct(left: pd.Series, right: pd.Series) -> tuple[np.ndarray, int, list[int], list[str], list[str]]:
    """The number of each row's pair among the distinct pairs, how many there are, and the numbers and sides of those without a null."""
    place: dict[tuple, int] = {}
    codes = np.fromiter((place.setdefault(pair, len(place)) for pair in zip(left.tolist(), right.tolist())), np.int64, len(left))
    known = [(i, x, y) for (x, y), i in place.items() if isinstance(x, str) and isinstance(y, str)]
    return codes, len(place), [i for i, _, _ in known], [x for _, x, _ in known], [y for _, _, y in known]


def comparator(compare: Callable[[list[str], list[str]], np.ndarray]) -> Callable[[Column, Column], Column]:
    """An Arrow function of two string columns from a comparator of batches; a pair that a batch repeats is compared once."""

    @F.pandas_udf("double")
    def run(left: pd.Series, right: pd.Series) -> pd.Series:
        codes, n, known, a, b = _distinct(left, right)
        value = np.full(n, np.nan)  # null
        if known:
            value[known] = compare(a, b)
        return pd.Series(value[codes])

    return run


def comparators(kinds: list[str]) -> Callable[[Column, Column], Column]:
    """The same for several comparators (by name) of the same columns, as one struct."""

    @F.pandas_udf(", ".join(f"{kind} double" for kind in kinds))
    def run(left: pd.Series, right: pd.Series) -> pd.DataFrame:
        codes, n, known, a, b = _distinct(left, right)
        value = {kind: np.full(n, np.nan) for kind in kinds}
        if known:
            for kind, found in compare_many(kinds, a, b).items():
                value[kind][known] = found
        return pd.DataFrame({kind: found[codes] for kind, found in value.items()})

    return run


#: Extension point: comparators by name.
COMPARATORS: dict[str, Callable[[list[str], list[str]], np.ndarray]] = {
    "ratio": ratio_many,
    "partial": partial_many,
    "token_sort": token_sort_many,
    "token_set": token_set_many,
    "weighted": weighted_many,
    "jaro_winkler": jaro_winkler_many,
}
#: The same for single pairs.
SINGLE: dict[str, Callable[[str, str], float]] = {"ratio": ratio, "partial": partial, "token_sort": token_sort, "token_set": token_set, "weighted": weighted, "jaro_winkler": jaro_winkler}

#: Extension point: (feature, column of the records, comparator). A matcher knows features by these names.
STRING_FEATURES: list[tuple[str, str, str]] = [
    ("nm_ratio", "name_core", "ratio"),
    ("nm_partial", "name_core", "partial"),
    ("nm_tsort", "name_core", "token_sort"),
    ("nm_tset", "name_core", "token_set"),
    ("nm_wratio", "name_core", "weighted"),
    ("nm_full_tset", "name_norm", "token_set"),
    ("nc_ratio", "name_compact", "ratio"),
    ("nc_partial", "name_compact", "partial"),
    ("nc_jw", "name_compact", "jaro_winkler"),
    ("nk_ratio", "name_skel_str", "ratio"),
    ("ad_ratio", "addr_norm", "ratio"),
    ("ad_tset", "addr_norm", "token_set"),
    ("ad_partial", "addr_norm", "partial"),
    ("ad_tsort", "addr_norm", "token_sort"),
]
