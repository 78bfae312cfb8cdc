"""Operators of the llm subpackage against brute force, on small and odd tables."""

import hashlib
import random
import zlib
from itertools import pairwise

import numpy as np
import pytest
import public_tokenizers as P
import tiktoken

from offblock.llm import bpe, ego_join, jaccard, language_id, lattice_lm, line_dedup, linking, packing, simhash, tool_calls, url_filter

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(r, n):
    return " ".join("".join(r.choice(["th", "er", "on", "an", "re", "nd"]) for _ in range(r.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty, short, very long and repeated texts; copies, near copies; a column named like an inner one."""
    r = random.Random(3)
    base = [prose(r, 60) for _ in range(12)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(base)]
    for i in range(40):
        w = r.choice(base[:4]).split()
        w[r.randrange(len(w))] = "new" * r.randint(0, 2)
        rows.append((20 + i, " ".join(w), "en", "s", 1))
    rows += [(100, None, None, None, None), (101, "", "en", "s", 0), (102, " \n\t ", "en", "s", 3), (103, "one two", "en", "s", 7),
             (104, "ONE  two", "fr", "s", 8), (None, base[0], "en", "s", 1), (None, None, None, None, None), (0, base[0], "en", "s", 1),
             (105, "x" * 30000, "en", "s", 30000), (106, prose(r, 4000), "en", "s", 1), (107, "é🙂 日本", "fr", "s", 5), (108, "12 34", "en", "s", 5)]
    return spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS node", "'k' AS key").repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def words(t):
    return (t or "").encode().lower().split()


def test_simhash_equal_texts_edits_and_neighbours(docs, empty):
    rows = simhash.op1_simhash(docs).collect()
    src = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or ""), r) for r in docs.collect())
    assert len(rows) == len(src)
    want = {}
    order = [r for _, r in src]
    known = [r for r in order if r.doc_id is not None]
    for i, r in enumerate(order):
        nxt = order[i + 1] if i + 1 < len(order) else known[0]
        t, n = r.text or "", len(r.text or "")
        want.setdefault((r.doc_id, n), []).append(hashlib.sha256((t[: n - n // 2] + (nxt.text or "")[: n // 2]).encode()).hexdigest())
    got = {}
    for r in rows:
        got.setdefault((r.doc_id, r.n_chars), []).append(r.edited_sha256)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    by_text = {r.doc_id: r.fingerprint for r in rows if r.doc_id is not None}
    assert by_text[100] == by_text[101] == by_text[102] == "0" * 16
    assert simhash.op1_simhash(empty).count() == 0


def test_simhash_block_tables_find_all(spark):
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(5)]
    fps = {b ^ sum(1 << k for k in r.sample(range(64), r.randint(0, 5))) for b in base for _ in range(40)}
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x, 2) for x in signed], "fp long, n long")
    got = {x["fp"]: x["n"] for x in simhash.near_counts(df, df.select("fp")).collect()}
    assert got == {x: sum(2 for y in signed if bin((x ^ y) & (2**64 - 1)).count("1") <= 3) for x in signed}


def test_url_filter(spark):
    urls = ["http://a.net/x", "http://A.Example.NET/en/1", "http://example.net/en", "https://example.com/de/", "http://xorg/fr/", "ftp://b.org/fr/x?y#z",
            "http://net", "http://net/", None, "no scheme", "", "http://", "http://a.net:80/en/", "x://b.c.example.com/de/a/b/c?q=http://net/", "http://a.net/x"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "'r' AS rule", "'h' AS host")

    def judge(u):
        if u is None or "://" not in u:
            return "", "", None, "allow"
        rest = u.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:cut].lower(), rest[cut:].split("?")[0].split("#")[0]
        hits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, *(max(hits)[1:] if hits else (None, "allow")))

    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.op2_url_filter(df).collect()}
    assert got == {i: judge(u) for i, u in enumerate(urls)}


def test_crf_posteriors_match_enumeration():
    rng = np.random.default_rng(1)
    e, t, size = rng.normal(size=(7, 3)), rng.normal(size=(3, 3)), np.array([2, 4, 1])
    got, at = language_id.posteriors(e, size, t), 0
    for n in size:
        p = np.zeros((n, 3))
        for path in np.ndindex(*[3] * n):
            w = np.exp(sum(e[at + i, y] for i, y in enumerate(path)) + sum(t[a, b] for a, b in pairwise(path)))
            for i, y in enumerate(path):
                p[i, y] += w
        assert np.allclose(p / p.sum(1, keepdims=True), got[at : at + n])
        at += n


def test_language_id_held_out_accuracy_and_odd_rows(spark, sf, docs, empty):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    got = language_id.op3_language_id(d).join(d.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    odd = {r.doc_id: r for r in language_id.op3_language_id(docs).collect()}
    assert all(odd[i].lang_pred == "und" and odd[i].score == 0 for i in (100, 101, 102, 108))
    assert odd[105].lang_pred in ("en", "fr") and language_id.op3_language_id(empty).count() == 0


def test_tool_calls(spark):
    calls = spark.createDataFrame([(1, 0, "a", "t", '{"n":1}', None), (1, 2, "b", "t", '{"n":"x"}', "a"), (1, 4, "c", "t", "{bad", "b"), (1, 5, "c", "t", '{"n":2}', "b"),
                                   (1, 6, "d", "u", "{}", "gone"), (2, 0, "x", "t", '{"n":2,"z":1}', "y"), (2, 1, "y", "t", '{"n":3}', "x"), (2, 2, None, "t", None, None)],
                                  "conv_id long, turn long, call_id string, name string, arguments string, after string")
    results = spark.createDataFrame([(1, 1, "a", "ok"), (1, 3, "b", None), (1, 7, "zz", "lost"), (2, 3, "x", "1"), (2, 4, "x", "2"), (2, 5, None, "n")],
                                    "conv_id long, turn long, call_id string, content string")
    schema = {"t": {"type": "object", "required": ["n"], "properties": {"n": {"type": "integer"}}, "additionalProperties": False}}
    rows = tool_calls.link_calls(calls, results, schema).collect()
    got = {(r.conv_id, r.turn, r.call_id): (r.status, r.depth, r.valid) for r in rows}
    assert got[1, 0, "a"] == ("linked", 0, True) and got[1, 2, "b"] == ("linked", 1, False)
    assert got[1, 4, "c"] == ("unanswered", 2, False) and got[1, 5, "c"][0] == "repeated" and got[1, 6, "d"][:2] == ("unanswered", 0)
    assert got[2, 0, "x"][:2] == ("linked", None) and got[2, 1, "y"][:2] == ("unanswered", None)
    assert got[1, 7, "zz"][0] == "orphan" and got[2, 5, None][0] == "orphan" and len(rows) == 11
    assert tool_calls.canonical({"b": [1, "é"], "a": None}) == '{"a":null,"b":[1,"é"]}'
    chain = spark.createDataFrame([(i, i - 1 if i else None) for i in range(100)], "key long, after long")
    assert {r.key: r.depth for r in tool_calls.depths(chain).collect()} == {i: i for i in range(100)}


def test_ego_join(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 8))
    vecs = [*base, *(base[:10] + 0.15 * rng.normal(size=(10, 8))), *[base[0] * 3] * 5]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vecs)]
    odd = [(900, None), (901, []), (902, [0.0] * 8), (903, [1.0, None]), (904, [float("nan")] * 8), (905, [1.0, 2.0]), (3, [1.0, 2.0]), (None, rows[0][1])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").selectExpr("*", "7 AS node", "1 AS label")
    got = ego_join.cosine_components(df).collect()
    m = np.array(vecs) / np.linalg.norm(vecs, axis=1, keepdims=True)
    hit = m @ m.T >= 0.9
    links = hit.sum(1) - 1
    label = np.arange(len(m))
    for _ in m:
        label = np.where(hit, label[None], len(m)).min(1)
    by = {}
    for r in got:
        by.setdefault(r.vec_id, []).append((r.n_links, r.component_id, r.kept))
    copies = {0, *range(50, 55)}
    for i in range(len(m)):
        extra = int(hit[0, i])  # the vector without an id
        if i != 3:
            assert by[i] == [(links[i] + extra, label[i], label[i] == i)], i
    assert copies and all(by[i] == [(0, i, True)] for i in (900, 901, 902, 903, 904)) and by[905] == [(1, 3, False)] and len(got) == len(rows) + len(odd)


def components(ids, linked):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_jaccard(docs, empty):
    got = jaccard.jaccard_components(docs).collect()
    rows = docs.select("doc_id", "text").collect()
    sets = []
    for r in rows:
        w = words(r.text)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    comp = components(range(len(rows)), pairs)
    low = {}
    for i, r in enumerate(rows):
        if r.doc_id is not None:
            low[comp[i]] = min(low.get(comp[i], r.doc_id), r.doc_id)
    want = sorted(((r.doc_id, len(s), low.get(comp[i])) for i, (r, s) in enumerate(zip(rows, sets, strict=True))), key=str)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == want
    assert jaccard.jaccard_components(empty).count() == 0
    kept = jaccard.keep_one_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({d for d, _, c in want if d is not None and d == c})


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
        p, k = r.randrange(len(b) + 1), r.randrange(3)
        if k == 0 or p == len(b):
            b.insert(p, r.choice("abc"))
        elif k == 1:
            b.pop(p)
        else:
            b[p] = r.choice("abc")
    return "".join(b)


def test_edit_distance_and_segments_are_exact():
    r = random.Random(1)
    for _ in range(3000):
        a = "".join(r.choice("ab") for _ in range(r.randint(0, 9)))
        b = mutate(r, a, r.randint(0, 4))
        for e in (1, 2, 3):
            assert line_dedup.within(a, b, e) == (edits(a, b) <= e)
        x, y = sorted((a, b), key=len)
        if edits(a, b) <= 2 and len(x) >= 3:
            own = {(l, i, x[s : s + z]) for l, i, s, z in line_dedup.probes(len(x))}
            assert own & {(l, i, y[s : s + z]) for l, i, s, z in line_dedup.probes(len(y))}


def test_line_dedup(spark, empty, monkeypatch):
    r = random.Random(4)
    base = [prose(r, 14)[:60] for _ in range(6)]
    base = [b for b in base if len(b) >= 44]
    docs = []
    for i in range(60):
        lines = [mutate(r, r.choice(base), r.randint(0, 3)) for _ in range(r.randint(1, 4))] + ["short"] * r.randint(0, 2)
        docs.append((i, "\n".join(lines), "en", "s", 1))
    docs += [(70, None, "en", "s", 1), (71, "", "en", "s", 1), (None, base[0], "en", "s", 1), (5, docs[5][1], "en", "s", 1), (72, "short", "en", "s", 1)]
    monkeypatch.setattr(linking, "REFINED_NODES", 3)  # refine on this small table, too
    df = spark.createDataFrame(docs, DOCS).selectExpr("*", "'z' AS line", "2 AS node").repartition(4)
    seen = sorted({(i if i is not None else line_dedup.LAST_ID, k, x) for i, t, *_ in docs for k, x in enumerate((t or "").split("\n")) if len(x) >= line_dedup.MIN_CHARS})
    distinct = sorted({x for *_, x in seen})
    comp = components(range(len(distinct)), [(i, j) for i in range(len(distinct)) for j in range(i) if edits(distinct[i], distinct[j]) <= line_dedup.EDITS])
    place = {x: comp[i] for i, x in enumerate(distinct)}
    first = {}
    for i, k, x in seen:
        first.setdefault(place[x], (i, k))
    want = []
    for i, t, *_ in docs:
        kept = [x for k, x in enumerate((t or "").split("\n")) if len(x) < line_dedup.MIN_CHARS or first[place[x]] == (i if i is not None else line_dedup.LAST_ID, k)]
        want.append((i, (t or "").count("\n") + 1, (t or "").count("\n") + 1 - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    got = [(x.doc_id, x.n_lines, x.n_dropped, x.kept_sha256) for x in line_dedup.line_report(df).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert line_dedup.line_report(empty).count() == 0
    assert line_dedup.dedup_lines(df).columns == df.columns


def test_lattice_sums_all_segmentations_and_scores(docs, empty):
    lattice = lattice_lm.Lattice.existing(P.path("piece_bpe_32k.model"))

    def brute(w, i=0):
        if i == len(w):
            return lattice.end
        total = sum((lattice.rest if i else lattice.first)[lattice.id[w[i:j]]] * brute(w, j) for j in range(i + 1, len(w) + 1) if w[i:j] in lattice.id)
        raw = w[i].encode()
        return total + (lattice.rest_bytes if i else lattice.first_bytes)[raw[0]] * np.prod(lattice.rest_bytes[list(raw[1:])]) * brute(w, i + 1)

    for w in ("a", "thnter,", "é🙂x"):
        assert np.isclose(lattice.log_word(w), np.log(brute(w)))
    several = ["a", "thnter,", "é🙂x", "", "other", "x" * 100, "there", "日本"]
    assert np.allclose(lattice.log_words(several), [lattice.log_word(w) if w else lattice.log_end for w in several])
    counts = lattice_lm.Counts(len(lattice.vocab))
    lattice.expected(["other", "there"], counts)
    assert counts.words == 2 and counts.first.sum() + counts.first_bytes.sum() == pytest.approx(2)
    got = lattice_lm.op8_lattice_lm(docs).collect()
    rows = docs.select("doc_id", "text").collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = {}
    for r in rows:
        if not held(r.doc_id):
            for w in [*words(r.text), b""]:
                c[w] = c.get(w, 0) + 1
    n = sum(c.values())
    want = sorted(((r.doc_id, held(r.doc_id), len(words(r.text)) + 1, sum(w in c for w in [*words(r.text), b""]), n,
                    round(sum(np.log10((c.get(w, 0) + 1) / (n + len(c) + 1)) for w in [*words(r.text), b""]), 4)) for r in rows), key=str)
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got), key=str) == want
    assert all(np.isfinite(r.score) and r.score < 0 for r in got) and lattice_lm.op8_lattice_lm(empty).count() == 0


def test_bpe_equals_tiktoken(docs, empty):
    ranks = bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    real = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coder = bpe.Encoder(ranks, P.PATTERN)
    r = random.Random(2)
    pieces = [bytes(r.choice(b"thear nio\xc3\xa9") for _ in range(r.randint(1, 80))) for _ in range(500)]
    for p, ids in zip(pieces, coder.encode_many(pieces), strict=True):
        assert ids == ",".join(map(str, real._encode_single_piece(p)))
        assert p in ranks or ids == ",".join(map(str, coder.encode_long(p)))
    for t in [" a  b \n c ", "\xa0 x y 's don't", " ", "a \xa0b", "x\n\ny \t z'll", "a\0 b"]:
        coder.learn(set(coder.cut(t)))
        assert ",".join(coder.ids_of[x] for x in coder.cut(t)) == ",".join(map(str, real.encode_ordinary(t)))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for x in docs.select("doc_id", "text").collect():
        ids = real.encode_ordinary(x.text or "")
        want.append((x.doc_id, len(ids), sha(",".join(map(str, ids)).encode()), sha((x.text or "").encode())))
    got = [(x.doc_id, x.n_tokens, x.ids_sha256, x.decoded_sha256) for x in bpe.op9_bpe(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and bpe.op9_bpe(empty).count() == 0


def test_packing(docs, empty):
    where, offset, final = packing.best_fit([5, 3, 3, 2, 7], (4, 8))
    assert sorted(set(where)) == list(range(len(final))) and all(final[b] >= sum(s for s, w in zip([5, 3, 3, 2, 7], where, strict=True) if w == b) for b in where)
    got = packing.pack_documents(docs).collect()
    assert sum(r.n_tokens for r in got) == sum(len(words(r.text)) + 1 for r in docs.collect())
    bins = {}
    for r in got:
        bins.setdefault(r.bin_id, []).append(r)
    for rows in bins.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.bin_offset):
            assert r.bin_offset == at
            at += r.n_tokens
        assert {r.bin_used for r in rows} == {at} and {r.bin_length for r in rows} == {min(c for c in packing.LENGTHS if c >= at)}
    assert packing.pack_documents(empty).count() == 0
    assert sorted(map(str, packing.pack_documents(docs.repartition(3)).collect())) == sorted(map(str, got))


def test_pipeline(spark, sf):
    import corpus_pipeline as C

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    first = C.language_id(spark, docs, sf)
    assert first.columns == docs.columns and first.count() >= 0.99 * docs.where("text rlike '[A-Za-z]'").count()
    out = C.run(spark, sf)
    assert [n for n, _ in C.STAGES] == ["language_id", "line_dedup", "jaccard", "packing"] and 0 < out.select("doc_id").distinct().count() <= docs.count()
