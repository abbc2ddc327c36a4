"""Comparisons of many pairs of strings at once, as columns of machine words.

lengths(): a pair's shorter string takes the bits of one 64-bit word; for each character of the longer one all pairs of a chunk do one bit-parallel
step. Pairs whose shorter string is longer than WORD characters go to a function of single pairs, which the caller gives.

best_windows(): a pair's table of characters is combed once (semi-local longest common subsequences, Tiskin), which gives the lengths for all
windows of the longer string. The cells of an antidiagonal do not depend on each other, so a step does those of all pairs of a chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

WORD = 64
#: Entries of a chunk's table of characters, and of windows, at most.
CELLS = 1 << 21
#: Cells of an antidiagonal at most, for all pairs of a chunk.
VECTOR = 1 << 15
#: What a step costs beside its cells, in cells.
STEP = 7000
#: Strings up to this many characters are compared as columns by jaro_winkler().
SHORT = 128


def codes_of(texts: list[str], width: int) -> np.ndarray:
    """The characters of each text as numbers, one row for each; 0 past the end, characters one higher."""
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) + 1
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    out = np.zeros((len(texts), width), np.int64)
    row = np.repeat(np.arange(len(texts)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _chunks(order: np.ndarray, cost: np.ndarray) -> Iterator[np.ndarray]:
    """Rows in runs whose costs add up to CELLS, or single ones."""
    begin, total = 0, 0
    for i, c in enumerate(cost[order].tolist()):
        if i > begin and total + c > CELLS:
            yield order[begin:i]
            begin, total = i, 0
        total += c
    if begin < len(order):
        yield order[begin:]


def _table(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each pair the places of each character of `short` as bits, and `long` in the numbers of that table."""
    letters = np.unique(short)
    at, other = np.searchsorted(letters, short), np.searchsorted(letters, long)
    other = np.where(letters[np.minimum(other, len(letters) - 1)] == long, other, len(letters))
    other[long == 0] = len(letters)
    table = np.zeros((len(short), len(letters) + 1), np.uint64)
    rows = np.arange(len(short))
    for i in range(short.shape[1]):
        used = short[:, i] > 0
        table[rows[used], at[used, i]] |= np.uint64(1 << i)
    return table, other


def _full(sizes: np.ndarray) -> np.ndarray:
    """Words whose lowest `sizes` bits are set."""
    return np.where(sizes == 0, np.uint64(0), np.uint64(0xFFFFFFFFFFFFFFFF) >> (64 - np.maximum(sizes, 1)).astype(np.uint64))


def _split(short: list[str], long: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    m, n = (np.fromiter(map(len, x), np.int64, len(x)) for x in (short, long))
    return m, n, m <= WORD


def lengths(a: list[str], b: list[str], single: Callable[[str, str], int]) -> np.ndarray:
    """Lengths of the longest common subsequences of all pairs."""
    swap = [len(x) > len(y) for x, y in zip(a, b)]
    short, long = [y if s else x for s, x, y in zip(swap, a, b)], [x if s else y for s, x, y in zip(swap, a, b)]
    m, n, fits = _split(short, long)
    out = np.zeros(len(a), np.int64)
    for i in np.flatnonzero(~fits).tolist():
        out[i] = single(short[i], long[i])
    rows = np.flatnonzero(fits & (m > 0))
    for chunk in _chunks(rows[np.argsort(n[rows], kind="stable")], n + WORD):
        table, other = _table(codes_of([short[i] for i in chunk], int(m[chunk].max())), codes_of([long[i] for i in chunk], int(n[chunk].max())))
        full = _full(m[chunk])
        state, own = full.copy(), np.arange(len(chunk))
        for j in range(other.shape[1]):
            u = state & table[own, other[:, j]]
            state = ((state + u) | (state - u)) & full
        out[chunk] = m[chunk] - np.bitwise_count(state)
    return out


def _comb(short: np.ndarray, long: np.ndarray, base: int) -> np.ndarray:
    """For each column of `long` the column in which the strand that leaves it at the bottom began at the top; negative: it began at the side.

    short (m, pairs) and long (n, pairs) are characters below `base`, a power of two; strands are numbers from `base` on, so that a character
    less one is below all of them, and above them where characters are equal and the number wraps.
    """
    (m, k), n = short.shape, len(long)
    a, b = np.ascontiguousarray(short[::-1]).ravel(), np.ascontiguousarray(long).ravel()
    h, v = (np.repeat(np.arange(first, first + size, dtype=a.dtype), k) for first, size in ((base, m), (base + m, n)))
    one, x, y = a.dtype.type(1), np.empty(min(m, n) * k, a.dtype), np.empty(min(m, n) * k, a.dtype)
    for d in range(m + n - 1):
        last = min(m - 1, d)
        size = (last - max(0, d - n + 1) + 1) * k
        i, j = (m - 1 - last) * k, (d - last) * k
        of_h, of_v, t, both = h[i : i + size], v[j : j + size], x[:size], y[:size]
        np.bitwise_xor(a[i : i + size], b[j : j + size], out=t)
        np.subtract(t, one, out=t)
        np.bitwise_xor(of_h, of_v, out=both)
        # Strands change places where characters are equal, or where they have crossed before.
        np.maximum(t, of_h, out=t)
        np.minimum(t, of_v, out=of_h)
        np.bitwise_xor(both, of_h, out=of_v)
    return v.reshape(n, k).astype(np.int64) - base - m


def _alphabet(short: list[str], long: list[str], width: int, height: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Both sides as (place, pair) of small numbers from 2 on, 0 and 1 past the ends, and a power of two above them."""
    a, b = codes_of(short, width).T, codes_of(long, height).T
    used = np.zeros(int(max(a.max(), b.max())) + 1, bool)
    used[a.ravel()] = used[b.ravel()] = True
    used[0] = False
    number = np.cumsum(used) + 1
    base = 1 << int(number[-1]).bit_length()
    kind = np.uint16 if base + width + height < 0xFFFF else np.uint32
    return np.where(a > 0, number[a], 0).astype(kind), np.where(b > 0, number[b], 1).astype(kind), base


def _close_sizes(m: np.ndarray, n: np.ndarray) -> Iterator[np.ndarray]:
    """Rows in runs that cost less together, padded, than each alone, with some VECTOR cells to an antidiagonal at most."""
    cost = lambda a, b, rows: (a + b) * STEP + a * b * rows
    order = np.lexsort((n, np.ceil(np.log(np.maximum(m, 1)) * 4)))
    begin, width, height, total = 0, 0, 0, 0
    for i, (a, b) in enumerate(zip(m[order].tolist(), n[order].tolist())):
        wider, higher, rows = max(width, a), max(height, b), i - begin + 1
        if i > begin and (rows * wider > VECTOR or cost(wider, higher, rows) > total + cost(a, b, 1)):
            yield order[begin:i]
            begin, wider, higher, rows = i, a, b, 1
        width, height, total = wider, higher, cost(wider, higher, rows)
    if begin < len(order):
        yield order[begin:]


def best_windows(short: list[str], long: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each pair the best indel ratio of `short` (not empty, not longer) with a window of `long` of as many characters, fewer at the ends;
    and the length of the longest common subsequence of the whole strings."""
    sizes, wholes = (np.fromiter(map(len, x), np.int64, len(x)) for x in (short, long))
    out, common = np.zeros(len(short)), np.zeros(len(short), np.int64)
    for chunk in _close_sizes(sizes, wholes):
        m, n = sizes[chunk], wholes[chunk]
        begins = _comb(*_alphabet([short[i] for i in chunk], [long[i] for i in chunk], int(m.max()), int(n.max())))
        k = len(chunk)
        place = np.arange(len(begins))[:, None]
        # What a window lacks to its length are the strands that begin and end in it.
        whole = (begins >= 0) & (place < n)
        common[chunk] = n - whole.sum(axis=0)
        ends, pair = np.nonzero(whole)
        starts = begins[ends, pair]
        size = place + 1
        inner = (size < m) & (size <= n)
        value = lambda missing: np.where(inner, 200.0 * (size - missing) / (m + size), 0.0).max(axis=0)
        best = value(np.cumsum(whole, axis=0))
        # strands by the distance of their beginning from the right end
        back = np.bincount((n[pair] - 1 - starts) * k + pair, minlength=begins.size).reshape(begins.shape)
        best = np.maximum(best, value(np.cumsum(back, axis=0)))
        first, last = np.maximum(ends - m[pair] + 1, 0), np.minimum(starts, (n - m)[pair])
        some = first <= last
        width = int((n - m).max()) + 2
        steps = lambda at: np.bincount(at[some] * k + pair[some], minlength=width * k).reshape(width, k)
        missing = np.cumsum(steps(first) - steps(last + 1), axis=0)
        most = np.where(np.arange(width)[:, None] <= n - m, m - missing, 0).max(axis=0)
        out[chunk] = np.maximum(best, 200.0 * most / (m + m))
    return out, common


def jaro_winkler(a: list[str], b: list[str], single: Callable[[str, str], float]) -> np.ndarray:
    """Jaro-Winkler similarities of all pairs."""
    m, n = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
    out = np.zeros(len(a))
    fits = (np.maximum(m, n) <= SHORT) & (m > 0) & (n > 0)
    for i in np.flatnonzero(~fits).tolist():
        out[i] = single(a[i], b[i])
    rows = np.flatnonzero(fits)
    for chunk in _chunks(rows[np.argsort(np.maximum(m, n)[rows], kind="stable")], m + n):
        la, lb = m[chunk], n[chunk]
        x, y = codes_of([a[i] for i in chunk], int(la.max())), codes_of([b[i] for i in chunk], int(lb.max()))
        reach = np.maximum(np.maximum(la, lb) // 2 - 1, 0)
        free, own, place = y > 0, np.arange(len(chunk)), np.arange(y.shape[1])
        matched = np.zeros(x.shape, bool)
        for i in range(x.shape[1]):
            near = free & (y == x[:, i, None]) & (np.abs(place - i) <= reach[:, None]) & (x[:, i, None] > 0)
            first = near.argmax(axis=1)
            hit = near[own, first]
            matched[:, i] = hit
            free[own[hit], first[hit]] = False
        taken = (y > 0) & ~free
        count = matched.sum(axis=1)
        # matched characters of both sides, in order
        p = np.take_along_axis(x, np.argsort(~matched, axis=1, kind="stable"), 1)
        q = np.take_along_axis(y, np.argsort(~taken, axis=1, kind="stable"), 1)
        width = min(p.shape[1], q.shape[1])
        moved = ((p[:, :width] != q[:, :width]) & (np.arange(width) < count[:, None])).sum(axis=1) // 2
        some = np.maximum(count, 1)
        jaro = np.where(count > 0, (count / la + count / lb + (count - moved) / some) / 3, 0.0)
        same = np.cumprod((x[:, :4][:, : min(4, x.shape[1], y.shape[1])] == y[:, : min(4, x.shape[1], y.shape[1])]) & (x[:, : min(4, x.shape[1], y.shape[1])] > 0), axis=1).sum(axis=1)
        value = np.where(jaro > 0.7, jaro + 0.1 * same * (1 - jaro), jaro)
        out[chunk] = np.where([a[i] == b[i] for i in chunk], 1.0, value)
    return out
