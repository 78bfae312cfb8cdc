"""Operator 13 against plain Python: base counts, the learned list, odd tables."""

import random
import re
from collections import Counter

import pytest

from offblock.llm import quality_rules as Q

DOCS = "doc_id long, text string, n_words string, rule string"
LABELS = "doc_id long, quality int, toxic int"
SYMBOLS = "#*$%&|<>"


def base(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    seen, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if seen[x] > 1:
            covered |= set(range(i, i + 5))
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(t.count(c) for c in SYMBOLS), len(lines) - len(set(lines)), len(covered)


def prose(r, n):
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    out = []
    for i in range(300):
        text, bad = prose(r, r.randint(12, 200)), i % 4 == 0
        if bad and i % 8:
            text = " | ".join(text.split())
        elif bad:
            text = " ".join(r.choice(["the", "a", "of"]) for _ in range(60))
        out.append((i, text, int(not bad)))
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    r = random.Random(6)
    passage = prose(r, 9)
    odd = ["", None, " \t\n\x0b\x0c\r ", "one", "a b c d e", "a b c d e f a b c d e", "x x x x x x x", "x\ny\nx\n x\n\n\n x", "é🙂 日本 #é", "   x",
           passage + " q " + passage, (passage + "\n") * 3, prose(r, 20000), (prose(r, 7) + " ") * 3000, "A b|c <d> $e% &f *g", "y" * 50000, "a\r\nb\r\na"]
    more = [(1000 + i, t) for i, t in enumerate(odd)] + [(None, "null id " * 9), (0, rows[0][1]), (0, rows[0][1])]
    return spark.createDataFrame([(i, t, "mine", "theirs") for i, t, _ in rows] + [(i, t, None, None) for i, t in more], DOCS).repartition(5)


@pytest.fixture(scope="module")
def labels(spark, rows):
    odd = [(None, 0, 0), (3, None, None), (1000, None, 1), (5, 7, 0), (99999, 0, 0), (4, 0, 0)]
    return spark.createDataFrame([(i, q, 0) for i, _, q in rows] + odd, LABELS)


def test_base_counts(docs, labels):
    got = Q.op13_quality_rules(docs, labels).collect()
    want = Counter((r.doc_id, *base(r.text)) for r in docs.collect())
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and r.rule is None)


def test_list_separates_the_labels(docs, labels, rows):
    got = {r.doc_id: r for r in Q.op13_quality_rules(docs, labels).collect()}
    wrong = [i for i, _, q in rows if (got[i].rule is None and not got[i].base_failed) != (q == 1)]
    assert len(wrong) <= 3
    assert not [i for i, _, q in rows if q == 1 and not got[i].kept]


def brute_rules(rows, cuts):
    """Sequential covering over plain rows (values by feature, bad, fold)."""
    bins = [([sum(c < v[f] for c in at) for f, at in enumerate(cuts)], bad, fold == 2) for v, bad, fold in rows]
    found = []
    for _ in range(Q.MAX_RULES):
        grow, prune = [x for x in bins if not x[2]], [x for x in bins if x[2]]
        rule, inside = [], grow
        while len(rule) < Q.MAX_CONDITIONS and 0 < sum(x[1] for x in inside) < len(inside):
            p0 = sum(x[1] for x in inside)
            best = None
            for f, at in enumerate(cuts):
                for b in range(len(at)):
                    for above in (False, True):
                        fit = [x for x in inside if (x[0][f] > b) == above]
                        p = sum(x[1] for x in fit)
                        g = Q.gain(p0, len(inside) - p0, p, len(fit) - p)
                        if g > 1e-9 and (best is None or g > best[0] + 1e-9):
                            best = (g, f, above, b)
            if best is None:
                break
            rule.append(best[1:])
            inside = [x for x in inside if (x[0][best[1]] > best[3]) == best[2]]
        if not rule:
            break
        fits = lambda x, k: all((x[0][f] > b) == above for f, above, b in rule[: k + 1])  # noqa: E731, B023
        sums = [(sum(x[1] for x in prune if fits(x, k)), sum(1 - x[1] for x in prune if fits(x, k))) for k in range(len(rule))]
        worth = [(p - n) / (p + n) if p + n else -1.0 for p, n in sums]
        k = max(range(len(rule)), key=lambda k: (worth[k], -k))
        p, n = sums[k]
        if p + n < Q.LEAST_ROWS or p < Q.LEAST_PRECISION * (p + n):
            break
        bins = [x for x in bins if not fits(x, k)]
        found.append(tuple(Q.Condition(Q.FEATURES[f], above, cuts[f][b]) for f, above, b in Q.tightest(rule[: k + 1])))
    return found


def test_rules_equal_brute_force(spark, docs, labels):
    rows = Q.labelled(Q.text_stats(docs), labels)
    plain = [([r[c] for c in Q.FEATURES], r.bad, r.fold) for r in rows.collect()]
    quantiles = [i / Q.BINS for i in range(1, Q.BINS)]
    import numpy as np

    cuts = []
    for f in range(len(Q.FEATURES)):
        x = np.sort([v[f] for v, _, _ in plain])
        at = [q * (len(x) - 1) for q in quantiles]
        cuts.append(sorted({float((np.floor(a) + 1 - a) * x[int(a)] + (a - np.floor(a)) * x[min(int(a) + 1, len(x) - 1)]) if x[int(a)] != x[min(int(np.ceil(a)), len(x) - 1)] else float(x[int(a)]) for a in at}))
    got, want = Q.learn_rules(rows), brute_rules(plain, cuts)
    assert got and [[(c.feature, c.above) for c in r] for r in got] == [[(c.feature, c.above) for c in r] for r in want]
    for a, b in zip(got, want, strict=True):
        assert [c.threshold for c in a] == pytest.approx([c.threshold for c in b])


def test_empty_and_unlabelled(spark, docs):
    none = spark.createDataFrame([], LABELS)
    assert Q.op13_quality_rules(docs.limit(0), none).count() == 0
    got = Q.op13_quality_rules(docs, none).collect()
    assert len(got) == docs.count() and all(r.rule is None and r.kept == (not r.base_failed) for r in got)
    one_class = spark.createDataFrame([(i, 1, 0) for i in range(50)], LABELS)
    assert Q.learn_rules(Q.labelled(Q.text_stats(docs), one_class)) == []


def test_no_python_on_the_path(docs, labels):
    plan = Q.judge(Q.text_stats(docs), [(Q.Condition("n_words", True, 3.0),)])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange hashpartitioning" not in plan
