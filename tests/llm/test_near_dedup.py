"""MinHash near-dedup against all pairs by brute force."""
import random

import pytest

from shopstat.llm import near_dedup as N

STRIP = "".join(map(chr, [0x20, *range(9, 14)]))


def brute(rows, size, ratio):
    p, q = ratio

    def shingles(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        for c in STRIP:
            low = low.replace(c, " ")
        w = [x for x in low.split(" ") if x]
        return {tuple(w)} if 0 < len(w) < size else {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}

    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            c = len(sets[i] & sets[j])
            if c and q * c >= p * len(sets[i] | sets[j]):
                up[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, len(s), low.get(find(i)), d == low.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)


def corpus(rng, groups, most):
    words = [f"w{i}" for i in range(4000)]
    rows = []
    for _ in range(groups):
        base = rng.choices(words, k=rng.randint(1, 140))
        for _ in range(rng.randint(1, most)):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                t[rng.randrange(len(t))] = rng.choice(words)
            rows.append(rng.choice([" ", "\n", " \t"]).join(t))
    rng.shuffle(rows)
    return [(3 * i + 1, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("size, ratio", [(3, (85, 100)), (5, (80, 100))])
def test_against_all_pairs(table, size, ratio):
    rows = corpus(random.Random(size), 90, 5)
    rows += [(-4, ""), (-3, None), (-2, "  \n"), (9001, "two words"), (9002, "TWO\x0bwords"), (9003, rows[0][1]), (rows[1][0], rows[1][1]), (None, rows[2][1]), (9005, "a\x1cb a\x85b c"), (9006, "a b a b c")]
    assert got(N.near_duplicates(table(rows, "doc_id long, text string"), size, ratio)) == brute(rows, size, ratio)


def test_mass_of_near_copies_in_blocks(table, monkeypatch):
    monkeypatch.setattr(N, "LONG_LIST", 8)
    monkeypatch.setattr(N, "BLOCK", 16)
    rng = random.Random(9)
    rows = corpus(rng, 3, 90) + [(10_000 + i, "common line of the mass " * 9 + f"tail {i // 4}") for i in range(40)]
    assert got(N.near_duplicates(table(rows, "doc_id long, text string"), 3, (85, 100))) == brute(rows, 3, (85, 100))


def test_chain_component(table):
    edges = table([(bytes([i + 1]), bytes([i])) for i in range(60)], "a binary, b binary")
    assert {r.root for r in N.components(edges).collect()} == {b"\0"}


def test_one_row_of_each_group_stays(table):
    text = " ".join(f"w{i}" for i in range(60))
    df = table([(4, text, 1), (2, text + " x", 2), (9, "other words " * 9, 3), (None, text, 4), (7, None, 5), (8, None, 6)], "doc_id long, text string, kept int")
    out = N.drop_near_duplicates(df)
    assert out.columns == df.columns and sorted(r.kept for r in out.collect()) == [2, 3, 5, 6]


def test_empty_table(table):
    assert N.near_duplicates(table([], "doc_id long, text string")).count() == 0


def test_threshold_misses_at_most_its_probability():
    t = N.needed_matches(24, 0.85, 1e-6)
    assert sum(N.math.comb(24, k) * 0.85**k * 0.15**(24 - k) for k in range(t)) <= 1e-6 and 8 <= t <= 12
