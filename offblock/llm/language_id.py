"""Operator 3, language ID: a linear-chain conditional random field over words.

Each word has a language label; a word of more than WIDTH letters (text without
blanks) is cut into pieces, each of which has one as words do. Its features are affixes (1 to 3 characters at
either end), inner bigrams and trigrams, and the word itself (lexicon), hashed
into 2**FEATURE_BITS weights a language; learned transition weights join
neighbours. Forward-backward gives each word's label probabilities, so text that
changes its language is labelled word by word. A document's language is the one
with the largest sum of them; its score is that sum's share.

The field is fitted by adaptive gradient steps on its likelihood, on a bounded
sample: about SAMPLE_DOCS labelled documents a language, RUNS runs of RUN_WORDS
words from each. Training sequences join runs of different documents, so that
changes of language are learned from. Sample and weights (fixed sizes a language)
are all that the driver holds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offblock.llm.common import held_out, small_batches

FOLDS = 4
FEATURE_BITS = 18
#: Labelled documents of each language that are fitted on (expected; twice as many at most), and what is taken of each.
SAMPLE_DOCS = 300
RUNS = 4
RUN_WORDS = 25
EPOCHS = 4
#: Words of which a task keeps features' sums, and words that are labelled together.
CACHE_WORDS = 300_000
BLOCK_WORDS = 400_000
#: Letters of a piece that a longer word is cut into, and those that it shares with the next one.
WIDTH = 24
OVERLAP = 2
NO_LANGUAGE = "und"


def letters(token: str) -> str:
    """Lower-cased letters of a token."""
    return (token if token.isalpha() else "".join(filter(str.isalpha, token))).lower()


def tokens_of(text: str | None) -> list[str]:
    """The tokens of a text, those of more than WIDTH letters as their pieces.

    Pieces cover all letters. They overlap, so each bigram and trigram lies in one.
    """
    tokens = (text or "").split()
    if max(map(len, tokens), default=0) <= WIDTH:
        return tokens
    out = []
    for token in tokens:
        word = token if len(token) <= WIDTH else "".join(filter(str.isalpha, token))
        if len(word) <= WIDTH:
            out.append(token)
        else:
            starts = range(0, len(word) - OVERLAP, WIDTH - OVERLAP)
            out += [word[i : i + WIDTH] for i in starts]
    return out


def _hashed(h: np.ndarray, salt: int) -> np.ndarray:
    h = (h ^ np.uint32(salt * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    h *= np.uint32(0xC2B2AE35)
    h ^= h >> np.uint32(16)
    return (h >> np.uint32(32 - FEATURE_BITS)).astype(np.int64)


def features(words: list[str]):
    """Columns (rows, hashed features) of words of letters: the word, affixes, bigrams and trigrams."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    width = int(size.max())
    c = np.array(words, dtype=f"U{width}").view(np.uint32).reshape(len(words), width)
    order = np.argsort(-size, kind="stable")  # the words that reach a place are a leading part
    c, size = c[order], size[order]
    reach = [int(np.searchsorted(-size, -k, side="right")) for k in range(width + 1)]  # words of at least k letters
    prime = np.uint32(16777619)
    whole = np.zeros(len(words), np.uint32)
    for k in range(width):
        n = reach[k + 1]
        whole[:n] = whole[:n] * prime + c[:n, k]
    yield order, _hashed(whole, 1)
    for k in range(1, min(3, width) + 1):
        n = reach[k]
        head, tail = np.zeros(n, np.uint32), np.zeros(n, np.uint32)
        for j in range(k):
            head = head * prime + c[:n, j]
            tail = tail * prime + c[np.arange(n), size[:n] - k + j]
        yield order[:n], _hashed(head, 1 + k)
        yield order[:n], _hashed(tail, 4 + k)
    for k in (2, 3):
        for i in range(width - k + 1):
            n = reach[i + k]
            if not n:
                break
            gram = np.zeros(n, np.uint32)
            for j in range(k):
                gram = gram * prime + c[:n, i + j]
            yield order[:n], _hashed(gram, 6 + k)


class Field:
    """Weights of features (2**FEATURE_BITS, L), of transitions (L, L) and the languages."""

    def __init__(self, languages: list[str]):
        self.languages = languages
        n = len(languages)
        self.w, self.t = np.zeros((1 << FEATURE_BITS, n), np.float32), np.eye(n)

    def emission(self, words: list[str]) -> np.ndarray:
        """(words, L): the sums of the words' feature weights."""
        out = np.zeros((len(words), len(self.languages)), np.float32)
        for rows, f in features(words) if words else ():
            out[rows] += self.w[f]
        return out

    def fit(self, runs: list[tuple[str, list[str]]], epochs: int = EPOCHS, seed: int = 7) -> Field:
        """Maximise the likelihood of the labels of runs (language, words)."""
        rng, n = np.random.default_rng(seed), len(self.languages)
        index = {x: i for i, x in enumerate(self.languages)}
        runs = [(index[x], words) for x, words in runs if words]
        if not runs:
            return self
        vocabulary = sorted({w for _, words in runs for w in words})
        rows, feats = map(np.concatenate, zip(*features(vocabulary), strict=True))
        by_word = np.argsort(rows, kind="stable")
        of = dict(zip(vocabulary, np.split(feats[by_word], np.cumsum(np.bincount(rows, minlength=len(vocabulary)))[:-1]), strict=True))
        runs = [(y, [of[w] for w in words]) for y, words in runs]
        g_w, g_t, rate = np.full(self.w.shape, 1e-6, np.float32), np.full(self.t.shape, 1e-6), 0.2
        for _ in range(epochs if n > 1 else 0):
            order = rng.permutation(len(runs))
            pairs = [(runs[a], runs[b]) for a, b in zip(order[::2], order[1::2], strict=False)] or [(runs[0], runs[0])]
            for at in range(0, len(pairs), 64):
                block = pairs[at : at + 64]
                seqs = [a[1] + b[1] for a, b in block]
                labels = [[a[0]] * len(a[1]) + [b[0]] * len(b[1]) for a, b in block]
                size = np.array([len(x) for x in seqs])
                flat = [f for x in seqs for f in x]
                owner = np.repeat(np.arange(len(flat)), [len(f) for f in flat])
                feats = np.concatenate(flat)
                e = np.stack([np.bincount(owner, self.w[feats, k], len(flat)) for k in range(n)], 1)
                y = np.concatenate([np.array(x) for x in labels])
                gamma, xi = posteriors(e, size, self.t, pairs=True)
                diff = -gamma
                diff[np.arange(len(y)), y] += 1
                d_w = np.stack([np.bincount(feats, diff[owner, k], len(self.w)) for k in range(n)], 1)
                inner = np.ones(len(y), bool)
                inner[np.cumsum(size) - 1] = False
                i = np.flatnonzero(inner)
                d_t = np.bincount(y[i] * n + y[i + 1], minlength=n * n).reshape(n, n) - xi
                d_w -= 1e-3 * self.w * (d_w != 0)
                g_w += d_w**2
                g_t += d_t**2
                self.w += (rate * d_w / np.sqrt(g_w)).astype(np.float32)
                self.t += rate * d_t / np.sqrt(g_t)
        return self


def posteriors(e: np.ndarray, size: np.ndarray, t: np.ndarray, pairs: bool = False):
    """Label probabilities of every word by forward-backward, for sequences laid end to end.

    e: (words, L) scores; size: words of each sequence. All sequences advance
    together, longest first, so those still running are a leading part. With
    pairs, also the expected transitions, summed.
    """
    order = np.argsort(-size, kind="stable")
    size, start = size[order], (np.cumsum(size) - size)[order]
    p, step = np.exp(e - e.max(1, keepdims=True)), np.exp(t - t.max())
    alpha, beta = np.empty_like(p), np.ones_like(p)
    longest = int(size[0]) if len(size) else 0
    running = np.searchsorted(-size, -np.arange(longest), side="left")  # sequences with more than i words
    for i in range(longest):
        at = start[: running[i]] + i
        a = p[at] if i == 0 else (alpha[at - 1] @ step) * p[at]
        alpha[at] = a / a.sum(1, keepdims=True)
    xi = np.zeros_like(t)
    for i in range(longest - 2, -1, -1):
        at = start[: running[i + 1]] + i
        onward = p[at + 1] * beta[at + 1]
        if pairs:
            joint = alpha[at][:, :, None] * step[None] * onward[:, None, :]
            xi += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
        b = onward @ step.T
        beta[at] = b / b.sum(1, keepdims=True)
    gamma = alpha * beta
    gamma /= gamma.sum(1, keepdims=True)
    return (gamma, xi) if pairs else gamma


def sample_runs(docs: DataFrame, sample: int = SAMPLE_DOCS) -> list[tuple[str, list[str]]]:
    """Runs of words (letters) of a bounded sample of labelled documents (doc_id, text, lang), spread over each text."""
    counts = {r["lang"]: r["count"] for r in docs.where("lang is not null").groupBy("lang").count().collect()}
    shares = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, sample / n)))]) if counts else None
    if not counts:
        return []
    chance = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    picked = docs.where("lang is not null").where(chance < F.element_at(shares, F.col("lang")))

    def run(batches):
        for batch in batches:
            lang, out = [], []
            for x, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = [w for w in map(letters, tokens_of(text)) if w]
                for k in range(RUNS if len(words) > RUN_WORDS else 1):
                    at = k * max(0, len(words) - RUN_WORDS) // max(1, RUNS - 1)
                    if words:
                        lang.append(x)
                        out.append(" ".join(words[at : at + RUN_WORDS]))
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(out, pa.string())], names=["lang", "words"])

    rows = picked.select("lang", "text").mapInArrow(run, "lang string, words string").limit(2 * sample * RUNS * len(counts)).collect()
    return sorted((r["lang"], r["words"].split(" ")) for r in rows)


def train(docs: DataFrame, sample: int = SAMPLE_DOCS) -> Field:
    """A field fitted on labelled documents (doc_id, text, lang); without labels it knows no language."""
    runs = sample_runs(docs, sample)
    return Field(sorted({x for x, _ in runs})).fit(runs)


PREDICTED = "lang_pred string, score double"


def predict(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """docs with lang_pred and score, from the text alone (columns of these names in docs are replaced).

    `und` and 0 for null texts, texts without a letter, and a field without
    languages. Ties go to the first language in order.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(field)
    kept = docs.drop("lang_pred", "score")
    names = kept.columns

    def run(batches):
        f = shared.value
        n = max(1, len(f.languages))
        index: dict[str, int] = {}
        table = np.zeros((CACHE_WORDS + 1, n), np.float32)  # row 0: no letters
        used = 0

        def learn(tokens):
            """Give the tokens rows of the table."""
            nonlocal table, used
            new = [t for t in tokens if t not in index]
            if used + len(new) > CACHE_WORDS:
                index.clear()
                new, used = list(tokens), 0
            if len(new) > len(table) - 1:  # more than the table holds: one very long text
                table = np.zeros((len(new) + 1, n), np.float32)
            words = list(map(letters, new))
            some = [i for i, w in enumerate(words) if w and f.languages]
            index.update(dict.fromkeys(new, 0))
            index.update((new[i], used + k) for k, i in enumerate(some, 1))
            table[used + 1 : used + 1 + len(some)] = f.emission([words[i] for i in some])
            used += len(some)

        def label(texts):
            """Sums of label probabilities of each text."""
            learn(set().union(*texts))
            rows = [np.fromiter(map(index.__getitem__, t), np.int64, len(t)) for t in texts]
            rows = [a[a > 0] for a in rows]
            size = np.array([len(a) for a in rows])
            live = size > 0
            sums = np.zeros((len(texts), n))
            if live.any():
                gamma = posteriors(table[np.concatenate(rows)].astype(np.float64), size[live], f.t)
                sums[live] = np.add.reduceat(gamma, np.cumsum(size[live]) - size[live], axis=0)
            return sums

        for batch in batches:
            sums, held, words = [], [], 0
            for t in batch.column(text).to_pylist():
                tokens = tokens_of(t)
                if held and words + len(tokens) > BLOCK_WORDS:
                    sums.append(label(held))
                    held, words = [], 0
                held.append(tokens)
                words += len(tokens)
            sums.append(label(held))
            total = np.concatenate(sums)
            mass = total.sum(1)
            best = total.argmax(1)
            pred = [f.languages[k] if m > 0 else NO_LANGUAGE for k, m in zip(best, mass, strict=True)]
            score = np.where(mass > 0, total.max(1) / np.where(mass > 0, mass, 1), 0.0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(pred, pa.string()), pa.array(np.minimum(score, 1.0))],
                                             names=[*names, "lang_pred", "score"])

    schema = kept.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return kept.mapInArrow(run, schema)


def op3_language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; fitted on rows that are not held out."""
    d = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), held_out("doc_id", FOLDS).alias("held_out"))
    field = train(d.where("not held_out").select("doc_id", "text", "lang"))
    return predict(d.select("doc_id", "held_out", "text"), field).drop("text")


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """Rows of docs in which one learned language holds at least the share `least`; others, and `und`, go.

    All columns of docs are kept as they are, those named lang_pred or score included.
    """
    field = train(docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")))
    own = [f"own_{i}" for i in range(len(docs.columns))]
    found = predict(docs.toDF(*own), field, own[docs.columns.index("text")])
    return found.where((F.col("lang_pred") != NO_LANGUAGE) & (F.col("score") >= least)).select(*own).toDF(*docs.columns)
