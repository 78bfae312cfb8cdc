"""Line dedup on lines of every length, against brute force."""

import hashlib
import random

import pytest

from offblock.llm import line_dedup, linking


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def mutate(r, a, n):
    b = list(a)
    for _ in range(n):
        p, k = r.randrange(len(b)), r.randrange(3)
        b[p : p + (k > 0)] = [] if k == 1 else [r.choice("xyz")]
    return "".join(b)


def dropped(lines):
    """The places of lines that are not the first of their class."""
    root = list(range(len(lines)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(lines):
        for j, b in enumerate(lines[:i]):
            allowed = min(2, min(len(a), len(b)) // 20)
            if a.strip() and b.strip() and (a == b or abs(len(a) - len(b)) <= allowed and edits(a, b) <= allowed):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i for i in range(len(lines)) if find(i) != i}


@pytest.mark.parametrize("refined", [3, linking.REFINED_NODES])
def test_lines_of_every_length(spark, monkeypatch, refined):
    r = random.Random(6)
    base = ["".join(r.choice("abcd ") for _ in range(n - 2)) + ".e" for n in (1 + 2, 7, 19, 20, 21, 24, 30, 38, 39, 40, 41, 42, 60) for _ in range(2)]
    pool = base + [mutate(r, r.choice(base), r.randint(1, 3)) for _ in range(110)]
    pool += ["", " ", "\t", "}", "}", "And therhean is the is esndha."] * 2
    lines = [r.choice(pool) for _ in range(260)]
    docs = [(i, lines[4 * i : 4 * i + 4]) for i in range(65)]
    monkeypatch.setattr(linking, "REFINED_NODES", refined)
    df = spark.createDataFrame([(i, "\n".join(x)) for i, x in docs], "doc_id long, text string").repartition(3)
    gone = dropped(lines)
    assert any(20 <= len(lines[i]) < 40 for i in gone) and any(0 < len(lines[i].strip()) < 20 for i in gone)
    want = {}
    for i, x in docs:
        kept = [y for k, y in enumerate(x) if 4 * i + k not in gone]
        want[i] = (len(x) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    assert {x.doc_id: (x.n_dropped, x.kept_sha256) for x in line_dedup.line_report(df).collect()} == want


def test_repeated_lines_of_20_to_39_characters(spark):
    lines = [("ab cd ef " * 5)[:n] for n in (20, 25, 30, 38, 39)]  # each further than its edits from the others, but 38 and 39
    df = spark.createDataFrame([(i, "\n".join(lines)) for i in range(4)], "doc_id long, text string")
    got = {x.doc_id: x.n_dropped for x in line_dedup.line_report(df).collect()}
    assert got == {0: 1, 1: 5, 2: 5, 3: 5}
