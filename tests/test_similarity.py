import random

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pairloom.functions import similarity as S

WORDS = st.text("abc ", max_size=14)


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


@given(WORDS, WORDS)
@settings(max_examples=300, deadline=None)
def test_lcs(a, b):
    assert S.lcs_length(a, b) == slow_lcs(a, b)


@given(WORDS, WORDS)
@settings(max_examples=300, deadline=None)
def test_partial_is_the_best_window(a, b):
    short, long = sorted((a, b), key=len)
    if not a or not b:
        assert S.partial(a, b) == (100.0 if a == b else 0.0)
        return
    m = len(short)
    windows = [long[max(0, s) : min(len(long), s + m)] for s in range(1 - m, len(long))]
    best = max(S.ratio(short, w) for w in windows)
    if len(a) == len(b):
        best = max(best, max(S.ratio(long, short[max(0, s) : min(m, s + m)]) for s in range(1 - m, m)))
    assert S.partial(a, b) == pytest.approx(best)


@given(WORDS, WORDS)
@settings(max_examples=200, deadline=None)
def test_bounds_and_symmetry(a, b):
    for name, f in S.SINGLE.items():
        top = 1.0 if name == "jaro_winkler" else 100.0
        assert 0 <= f(a, b) <= top + 1e-9
        assert f(a, b) == pytest.approx(f(b, a))


def slow_ratio(a, b):
    return 100.0 if a == b else 200.0 * slow_lcs(a, b) / (len(a) + len(b))


def slow_partial(a, b):
    if a == b:
        return 100.0
    if not a or not b:
        return 0.0
    sides = [(a, b)] * (len(a) <= len(b)) + [(b, a)] * (len(b) <= len(a))
    return max(slow_ratio(s, long[max(0, k) : k + len(s)]) for s, long in sides for k in range(1 - len(s), len(long)))


def slow_words(a, b):
    """What two strings share, and what each has alone, as sorted distinct words."""
    x, y = set(a.split()), set(b.split())
    return tuple(" ".join(sorted(w)) for w in (x & y, x - y, y - x))


def slow_token_sort(a, b):
    return slow_ratio(*(" ".join(sorted(t.split())) for t in (a, b)))


def slow_token_set(a, b):
    if not a.split() or not b.split():
        return 0.0
    both, left, right = slow_words(a, b)
    if both and (not left or not right):
        return 100.0
    with_left, with_right = (both + " " + left).strip(), (both + " " + right).strip()
    scores = [slow_ratio(with_left, with_right)]
    if both:
        scores += [slow_ratio(both, with_left), slow_ratio(both, with_right)]
    return max(scores)


def slow_weighted(a, b):
    if not a or not b:
        return 0.0
    longer = max(len(a), len(b)) / min(len(a), len(b))
    if longer < 1.5:
        return max(slow_ratio(a, b), 0.95 * slow_token_sort(a, b), 0.95 * slow_token_set(a, b))
    scale = 0.9 if longer <= 8 else 0.6
    both, left, right = slow_words(a, b)
    words = 100.0 if both else max(slow_partial(*(" ".join(sorted(t.split())) for t in (a, b))), slow_partial(left, right))
    return max(slow_ratio(a, b), scale * slow_partial(a, b), 0.95 * scale * words)


SLOW = {"ratio": slow_ratio, "partial": slow_partial, "token_sort": slow_token_sort, "token_set": slow_token_set, "weighted": slow_weighted}


@given(st.lists(st.tuples(st.one_of(WORDS, st.text("aé日 ", max_size=70)), WORDS), min_size=1, max_size=8))
@settings(max_examples=150, deadline=None)
def test_batches_against_brute_force(pairs):
    a, b = [x for x, _ in pairs], [y for _, y in pairs]
    for name, slow in SLOW.items():
        assert S.COMPARATORS[name](a, b).tolist() == pytest.approx([slow(x, y) for x, y in pairs]), name
        assert [S.SINGLE[name](x, y) for x, y in pairs] == pytest.approx([slow(x, y) for x, y in pairs]), name
    assert S.jaro_winkler_many(a, b).tolist() == pytest.approx([S.jaro_winkler(x, y) for x, y in pairs])


def test_pinned_values():
    """By hand: three of four letters shared; sorted words; shared words alone; a window."""
    assert S.ratio("abcd", "abed") == 75 and S.token_sort("b c a", "a b d") == 80
    assert S.token_set("a b c", "a b d") == 80 and S.partial("abc", "xxabcxx") == 100
    assert S.weighted("abc", "xxxabcxxx") == 90 and S.weighted("ab", "ab" + "x" * 20) == 60


def test_long_strings_in_batches():
    rng = random.Random(6)
    text = lambda n: "".join(rng.choices("abcd ", k=n))
    pairs = [(text(rng.choice((0, 5, 63, 64, 65, 200))), text(rng.choice((1, 64, 65, 130, 2000)))) for _ in range(60)]
    a, b = [x for x, _ in pairs], [y for _, y in pairs]
    for name, f in S.SINGLE.items():
        assert S.COMPARATORS[name](a, b).tolist() == pytest.approx([f(x, y) for x, y in pairs]), name


def test_conventions():
    assert S.ratio("", "") == 100 and S.ratio("", "a") == 0
    assert S.token_set("a b", "b a c") == 100 and S.token_set("", "a") == 0
    assert S.token_sort("b a", "a b") == 100
    assert S.weighted("", "") == 0


def test_jaro_winkler_against_duckdb():
    rng = random.Random(4)
    pairs = [("".join(rng.choices("abcd", k=rng.randint(0, 9))), "".join(rng.choices("abcd", k=rng.randint(0, 9)))) for _ in range(300)]
    con = duckdb.connect()
    for a, b in pairs:
        expected = con.execute("SELECT jaro_winkler_similarity(?, ?)", [a, b]).fetchall()[0][0]
        if a and b:
            assert S.jaro_winkler(a, b) == pytest.approx(expected, abs=1e-9), (a, b)


def test_null_in_null_out(spark):
    df = spark.createDataFrame([("a", None), ("a", "a"), (None, None)], "l string, r string")
    rows = df.select(S.comparator(S.ratio_many)("l", "r").alias("x")).collect()
    assert [r.x for r in rows] == [None, 100.0, None]


def test_windows_are_combed(monkeypatch):
    """Long strings are not compared window by window, and one pass gives ratio and partial."""
    rng = random.Random(8)
    text = lambda n, letters="abcd ": "".join(rng.choices(letters, k=n))
    pairs = [(text(rng.choice((1, 5, 64, 90, 200))), text(rng.choice((1, 64, 90, 200, 400)))) for _ in range(40)]
    pairs += [(text(70, letters), text(90, letters)) for letters in ("".join(map(chr, range(97, 400))), "a\U0001f600日 ")]
    want = [(S.partial(x, y), S.ratio(x, y)) for x, y in pairs]

    def alone(*_):
        raise AssertionError("a single pair")

    monkeypatch.setattr(S, "_windows", alone)
    partial, ratio = S.partial_and_ratio([x for x, _ in pairs], [y for _, y in pairs])
    assert list(zip(partial.tolist(), ratio.tolist())) == [pytest.approx(w) for w in want]
    # so many places that strands need more than 16 bits
    long = "ab" * 33_000 + "xyz" + "ab" * 500
    assert S.partial_many(["axyzb", "cdcd", "bab"], [long] * 3).tolist() == pytest.approx([80.0, 0.0, 100.0])


def test_comparators_together():
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abc", k=rng.randint(1, 9)))
    a, b = ([" ".join(word() for _ in range(rng.choice((0, 1, 3, 12)))) for _ in range(80)] for _ in range(2))
    made = S.compare_many(list(S.SINGLE), a, b)
    for name, f in S.SINGLE.items():
        assert made[name].tolist() == pytest.approx([f(x, y) for x, y in zip(a, b)]), name
