"""Line dedup against a brute-force version."""
import random
from collections import defaultdict

from shopstat.llm.line_dedup import Runs, dedup_lines, line_key

STRIP = "".join(map(chr, [0x20, *range(9, 14)]))


def key_of(line):
    k = line.strip(STRIP)
    k = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in k)
    return k if len(k) >= 10 else None


def brute(rows):
    holders = defaultdict(set)
    last = 2**63 - 1
    for d, t in rows:
        for line in (t or "").split("\n"):
            if key_of(line) is not None:
                holders[key_of(line)].add(last if d is None else d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if key_of(x) is None or min(holders[key_of(x)]) == (last if d is None else d)]
        out.append((d, "\n".join(left), len(lines), len(lines) - len(left)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.text or "", r.n_lines, r.n_dropped) for r in df.collect()), key=str)


def test_against_brute_force(table):
    rng = random.Random(3)
    pool = [f"A shared passage number {i} " for i in range(12)] + ["short", "", "  \t", "ÉÉÉÉÉÉÉÉÉ", "ÉÉÉÉÉÉÉÉÉÉ", "ééééé ééééé", "x\x0by z\x0cwvu ts\r"]
    rows = [(i, "\n".join(rng.choice([p, p.upper(), "  " + p]) for p in rng.choices(pool, k=rng.randint(0, 9)))) for i in range(120)]
    rows += [(5000, None), (5001, ""), (5002, "\n\n"), (7, rows[7][1]), (8, "another text of the same id"), (None, pool[0] + "\n" + "only in the null row"),
             (None, None), (-5, "\n".join(["a hot line that all hold"] * 3)), *[(900 + i, "A HOT LINE that all hold\nown line " + str(i) * 9) for i in range(300)]]
    df = table(rows, "doc_id long, text string")
    want = brute(rows)
    assert got(dedup_lines(df, batches=5, fanout=2)) == want
    assert got(dedup_lines(df, batches=1)) == want


def test_extra_and_clashing_columns(table):
    df = table([(1, "a line of ten or more", 9, "x"), (2, "a line of ten or more", 8, "y")], "doc_id long, text string, n_lines int, `a.b` string")
    out = dedup_lines(df)
    assert out.columns == ["doc_id", "text", "a.b", "n_lines", "n_dropped"]
    assert sorted((r.doc_id, r.text, r["a.b"], r.n_dropped) for r in out.collect()) == [(1, "a line of ten or more", "x", 0), (2, "", "y", 1)]


def test_empty_table(table):
    assert dedup_lines(table([], "doc_id long, text string")).count() == 0


def test_later_load_continues_the_runs(spark, table):
    runs = Runs(spark, fanout=2)
    first = got(dedup_lines(table([(1, "the line both hold")], "doc_id long, text string"), runs=runs))
    later = got(dedup_lines(table([(2, "The line both hold\nmy own line here")], "doc_id long, text string"), runs=runs))
    assert first == [(1, "the line both hold", 1, 0)] and later == [(2, "my own line here", 2, 1)]


def test_key_counts_code_points():
    assert line_key("ÉÉÉÉÉÉÉÉÉ".encode()) is None and line_key("ÉÉÉÉÉÉÉÉÉÉ".encode()) is not None
