"""Operator 8, LM scoring: the marginal probability of a text over all its subword segmentations.

The vocabulary of pieces and its first scores are an existing file's
(SentencePiece); no tokenizer is trained. ROUNDS rounds of expectation and
maximisation over all distinct training words fit the scores, apart for pieces
that begin a word and for the rest with the end of a word. A word's probability
sums all its segmentations by a log-space forward recursion over the lattice of
its characters; every character can also be spelled by its bytes, so no word has
probability 0.

Seen words get their share of the training tokens, with the lattice as a prior of
strength K: P(w) = (c(w) + K P_lattice(w)) / (N + K). K is the multiple of the
number of distinct words that gives the training words the best leave-one-out
likelihood. The text's log probability is the sum over its words and its end.

Word counts cover all training documents and grow with them. The HEAD_WORDS most
frequent words (a fixed number) are broadcast and scored where the text is; all
other words go through a join.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offblock.llm.common import held_out, larger, partitions, row_ids, small_batches, written

FOLDS = 7
#: Words that are broadcast.
HEAD_WORDS = 1 << 17
#: Rounds of fitting the pieces' scores; DELTA is added to each expected count.
ROUNDS = 2
FIT_CHARS = 40
#: Words of one length, up to FIT_CHARS characters, that are fitted on at a time; longer ones go one by one.
FIT_WORDS = 2048
DELTA = 0.01
#: Distinct words that a task counts before it gives them out, and scores that it keeps.
TASK_WORDS = 500_000
MARK = "▁"
END = ""  # the end of a text, among the words


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a text; A-Z lower-cased, split at the six blanks."""
    return (text or b"").lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over all rows of docs (text), the ends of texts included."""
    def run(batches):
        seen: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()).cast(pa.string()), pa.array(seen.values(), pa.int64())], names=["word", "c"])

        for batch in batches:
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                seen.update(words_of(text))
                seen[b""] += 1
                if len(seen) > TASK_WORDS:
                    yield out()
                    seen.clear()
        yield out()

    return docs.select("text").mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Lattice:
    """Probabilities of pieces that begin a word and of others, of bytes in either place, and of a word's end."""

    def __init__(self, vocab: list[str], first: np.ndarray, rest: np.ndarray, first_bytes: np.ndarray, rest_bytes: np.ndarray, end: float):
        self.vocab, self.id = vocab, {p: i for i, p in enumerate(vocab)}
        self.longest = max(map(len, vocab), default=1)
        # every beginning of a piece is a state, 0 is the empty one; a state and the place of a character lead to the next
        self.chars = np.array(sorted({ord(c) for p in vocab for c in p}), np.uint32)
        place, state = {chr(c): i + 1 for i, c in enumerate(self.chars.tolist())}, {"": 0}
        steps = {}
        for piece in vocab:
            for k in range(1, len(piece) + 1):
                if piece[:k] not in state:
                    state[piece[:k]] = len(state)
                    steps[state[piece[: k - 1]] * (len(place) + 1) + place[piece[k - 1]]] = state[piece[:k]]
        self.steps = np.array(sorted(steps), np.int64)
        self.leads = np.array([steps[k] for k in self.steps.tolist()], np.int64)
        self.piece_of = np.array([self.id.get(p, -1) for p in state], np.int64)
        one, more = first.sum() + first_bytes.sum(), rest.sum() + rest_bytes.sum() + end
        # index -1 is "no piece"
        self.first, self.rest = np.append(first / one, 0), np.append(rest / more, 0)
        self.first_bytes, self.rest_bytes, self.end = first_bytes / one, rest_bytes / more, end / more
        self.log_first, self.log_rest = ({p: math.log(v[i]) for i, p in enumerate(vocab)} for v in (self.first, self.rest))
        with np.errstate(divide="ignore"):
            self.log_first_at, self.log_rest_at = np.log(self.first), np.log(self.rest)  # "no piece" is -inf
        self.log_first_bytes, self.log_rest_bytes, self.log_end = np.log(self.first_bytes).tolist(), np.log(self.rest_bytes).tolist(), math.log(self.end)

    @classmethod
    def existing(cls, model_path: str) -> Lattice:
        """Pieces and scores of a file. Its scores fall by one a rank; a piece's weight is one over its rank."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        first: dict[str, float] = {}
        rest: dict[str, float] = {}
        byte = np.full(256, 1e-4)
        for i in range(model.get_piece_size()):
            piece, weight = model.id_to_piece(i), 1 / (10 + max(0.0, -model.get_score(i)))
            bare = piece.removeprefix(MARK)
            if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or not bare or MARK in bare:
                continue
            for kind in (first, rest):
                kind[bare] = max(kind.get(bare, 1e-4), weight if (kind is first) == (piece != bare) else 1e-4)
        vocab = sorted(first)
        return cls(vocab, np.array([first[p] for p in vocab]), np.array([rest[p] for p in vocab]), byte, byte.copy(), 1.0)

    def log_word(self, word: str) -> float:
        """log P(word): the forward recursion over all segmentations, in log space."""
        n = len(word)
        into: list[list[float]] = [[] for _ in range(n + 1)]
        exp, log, longest = math.exp, math.log, self.longest
        alpha, get, byte = 0.0, self.log_first.get, self.log_first_bytes
        for i in range(n):
            if i:
                terms = into[i]
                top = max(terms)
                alpha = top if len(terms) == 1 else top + log(sum([exp(x - top) for x in terms]))
                into[i] = []
            for j in range(i + 1, min(n, i + longest) + 1):
                p = get(word[i:j])
                if p is not None:
                    into[j].append(alpha + p)
            raw = word[i].encode("utf-8", "surrogatepass")  # the character's bytes, one by one
            into[i + 1].append(alpha + byte[raw[0]] + sum([self.log_rest_bytes[b] for b in raw[1:]]))
            get, byte = self.log_rest.get, self.log_rest_bytes
        top = max(into[n])
        return top + log(sum([exp(x - top) for x in into[n]])) + self.log_end

    def log_words(self, words: list[str]) -> list[float]:
        """log_word of each word. Words of one length go through the recursion together, up to FIT_WORDS at a time."""
        out, by_length = [0.0] * len(words), {}
        for at, w in enumerate(words):
            by_length.setdefault(len(w), []).append(at)
        for n, places in by_length.items():
            if n > FIT_CHARS:  # long words one by one, so that a block of them stays small
                for at in places:
                    out[at] = self.log_word(words[at])
                continue
            for start in range(0, len(places), FIT_WORDS):
                part = places[start : start + FIT_WORDS]
                for at, x in zip(part, self._log_block([words[at] for at in part]).tolist(), strict=True):
                    out[at] = x
        return out

    def forward(self, words: list[str]):
        """For words of one length: what their characters are, the pieces found, the bytes' probabilities and the sums over all beginnings.

        Returns the distinct characters and which of them stands where (characters x
        words); for each start, (end, words, piece numbers, probabilities) of the pieces
        found there; the probability of spelling each character; and alpha, of
        (characters + 1) x words.
        """
        n, m = len(words[0]), len(words)
        codes = np.array(words, f"U{n}").view(np.uint32).reshape(m, n).T if n else np.empty((0, m), np.uint32)
        chars, which = np.unique(codes, return_inverse=True)
        which = which.reshape(n, m)
        raw = [chr(c).encode("utf-8", "surrogatepass") for c in chars.tolist()]
        tail = np.array([float(np.prod(self.rest_bytes[list(c[1:])])) for c in raw])
        lead = np.array([c[0] for c in raw], np.int64)
        spelt = (self.rest_bytes[lead] * tail)[which]
        spelt[:1] = (self.first_bytes[lead] * tail)[which[:1]]
        # the characters' places in self.chars, from 1; 0 for those of no piece
        place = np.searchsorted(self.chars, chars)
        known = np.append(self.chars, np.uint32(0))[place] == chars
        known[place == len(self.chars)] = False
        char = np.where(known, place + 1, 0)[which].ravel()
        at, state, found = np.arange(n * m), np.zeros(n * m, np.int64), [[] for _ in range(n)]
        for k in range(min(n, self.longest) if len(self.steps) else 0):  # pieces of k + 1 characters, at all starts together
            left = np.searchsorted(at, (n - k) * m)
            at, state = at[:left], state[:left]
            key = state * (len(self.chars) + 1) + char[at + k * m]
            step = np.minimum(np.searchsorted(self.steps, key), len(self.steps) - 1)
            ok = self.steps[step] == key
            at, state = at[ok], self.leads[step[ok]]
            piece = self.piece_of[state]
            whole = piece >= 0
            places, piece = at[whole], piece[whole]
            cuts = np.searchsorted(places, np.arange(n + 1) * m)
            for i in range(n):
                if cuts[i] < cuts[i + 1]:
                    ids = piece[cuts[i] : cuts[i + 1]]
                    found[i].append((i + k + 1, places[cuts[i] : cuts[i + 1]] - i * m, ids, (self.rest if i else self.first)[ids]))
        alpha = np.zeros((n + 1, m))
        alpha[0] = 1
        for i in range(n):
            alpha[i + 1] += alpha[i] * spelt[i]
            for j, at, _, p in found[i]:
                alpha[j, at] += alpha[i, at] * p
        return (raw, which), found, spelt, alpha

    def _log_block(self, words: list[str]) -> np.ndarray:
        """log_word of words of one length."""
        total = self.forward(words)[3][-1] * self.end
        small = ~(total > 1e-290)  # less is beyond doubles
        out = np.log(np.where(small, 1, total))
        for k in np.flatnonzero(small):
            out[k] = self.log_word(words[k])
        return out

    def expected(self, words: list[str], counts: Counts) -> None:
        """Add to counts the expected uses of pieces in words of one length, over all their segmentations."""
        n, m = len(words[0]), len(words)
        (raw, which), found, spelt, alpha = self.forward(words)
        total = alpha[n] * self.end
        ok = total > 1e-290  # less is beyond doubles
        for k in np.flatnonzero(~ok):
            self.expected_long(words[k], counts)
        inverse = np.where(ok, 1 / np.where(ok, total, 1), 0)
        beta, used = np.zeros((n + 1, m)), ([], [])
        beta[n] = self.end
        for i in range(n - 1, -1, -1):
            beta[i] = spelt[i] * beta[i + 1]
            for j, at, ids, p in found[i]:
                rest = p * beta[j, at]
                beta[i, at] += rest
                used[i > 0].append((ids, alpha[i, at] * rest * inverse[at]))
        for kind, pieces in zip((counts.first, counts.rest), used, strict=True):
            if pieces:
                ids, x = (np.concatenate(v) for v in zip(*pieces, strict=True))
                kind += np.bincount(ids, x, len(kind))
        by = alpha[:n] * spelt * beta[1:] * inverse
        for kind, at in ((counts.first_bytes, slice(0, 1)), (counts.rest_bytes, slice(1, None))):
            for c, x in zip(raw, np.bincount(which[at].ravel(), by[at].ravel(), len(raw)).tolist(), strict=True):
                kind[c[0]] += x
                for b in c[1:]:
                    counts.rest_bytes[b] += x
        counts.words += int(ok.sum())

    def expected_long(self, word: str, counts: Counts) -> None:
        """`expected` of one word of any length, in log space; two numbers a character are held."""
        n, longest, exp, log = len(word), self.longest, math.exp, math.log

        def total(terms):
            top = max(terms)
            return top + log(sum([exp(x - top) for x in terms]))

        def steps(i):
            """(end, piece, log score) of the pieces at i; the character's bytes and their log score."""
            at, get = (self.log_rest_at if i else self.log_first_at), self.id.get
            found = [(j, k, float(at[k])) for j in range(i + 1, min(n, i + longest) + 1) if (k := get(word[i:j])) is not None]
            raw = word[i].encode("utf-8", "surrogatepass")
            return found, raw, (self.log_rest_bytes if i else self.log_first_bytes)[raw[0]] + sum([self.log_rest_bytes[b] for b in raw[1:]])

        alpha, beta = array("d", bytes(8 * (n + 1))), array("d", bytes(8 * (n + 1)))
        into: dict[int, list[float]] = {}
        for i in range(n):
            if i:
                alpha[i] = total(into.pop(i))
            found, _, spelt = steps(i)
            for j, _, p in found:
                into.setdefault(j, []).append(alpha[i] + p)
            into.setdefault(i + 1, []).append(alpha[i] + spelt)
        beta[n] = self.log_end
        every = total(into[n]) + self.log_end
        for i in range(n - 1, -1, -1):
            found, raw, spelt = steps(i)
            beta[i] = total([p + beta[j] for j, _, p in found] + [spelt + beta[i + 1]])
            pieces, spelling = (counts.rest, counts.rest_bytes) if i else (counts.first, counts.first_bytes)
            for j, k, p in found:
                pieces[k] += exp(alpha[i] + p + beta[j] - every)
            x = exp(alpha[i] + spelt + beta[i + 1] - every)
            spelling[raw[0]] += x
            for b in raw[1:]:
                counts.rest_bytes[b] += x
        counts.words += 1

    def refitted(self, words: DataFrame) -> Lattice:
        """The next round's lattice. As many sums as there are pieces, twice, reach the driver."""
        shared = words.sparkSession.sparkContext.broadcast(self)
        size = len(self.vocab)

        def run(batches):
            lattice, counts, by_length = shared.value, Counts(size), {}
            for batch in batches:
                for w in batch.column("word").to_pylist():
                    if len(w) <= FIT_CHARS:
                        group = by_length.setdefault(len(w), [])
                        group.append(w)
                        if len(group) >= FIT_WORDS:
                            lattice.expected(by_length.pop(len(w)), counts)
                    else:
                        lattice.expected_long(w, counts)
            for group in by_length.values():
                lattice.expected(group, counts)
            flat = counts.flat()
            at = np.flatnonzero(flat)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(flat[at], pa.float64())], names=["at", "x"])

        total = Counts(size).flat()
        for r in words.select("word").mapInArrow(run, "at long, x double").groupBy("at").agg(F.sum("x").alias("x")).collect():
            total[r["at"]] = r["x"]
        first, rest, fb, rb, end = np.split(total, [size, 2 * size, 2 * size + 256, 2 * size + 512])
        return Lattice(self.vocab, first + DELTA, rest + DELTA, fb + DELTA, rb + DELTA, float(end[0]) + DELTA)


class Counts:
    """Expected uses of pieces and bytes."""

    def __init__(self, size: int):
        self.first, self.rest = np.zeros(size + 1), np.zeros(size + 1)  # the last for "no piece"
        self.first_bytes, self.rest_bytes, self.words = np.zeros(256), np.zeros(256), 0

    def flat(self) -> np.ndarray:
        return np.concatenate([self.first[:-1], self.rest[:-1], self.first_bytes, self.rest_bytes, [self.words]])


class Scorer:
    """log10 scores of words, given their counts: tokens N, distinct words V, strength of the lattice K."""

    def __init__(self, lattice: Lattice, tokens: int, distinct: int, strength: float):
        self.lattice, self.tokens, self.distinct, self.strength = lattice, tokens, distinct, strength

    def base(self, c: int) -> float:
        return math.log10((c + 1) / (self.tokens + self.distinct + 1))

    def model(self, word: str, c: int, log_p: float | None = None) -> float:
        """log_p: the word's log probability by the lattice, if known."""
        if word != END and log_p is None:
            log_p = self.lattice.log_word(word)
        if not self.tokens:  # nothing to learn from
            return 0.0 if word == END else log_p / math.log(10)
        if word == END:
            return math.log10(max(c, 1) / (self.tokens + self.strength))
        new = log_p + math.log(self.strength)
        seen = math.log(c) if c else -math.inf
        top = max(new, seen)
        return (top + math.log(math.exp(new - top) + math.exp(seen - top)) - math.log(self.tokens + self.strength)) / math.log(10)


def best_strength(words: DataFrame, tokens: int, distinct: int) -> float:
    """The multiple of distinct with the best leave-one-out likelihood of words (word, c, log_p)."""
    grid = [distinct * 2.0**k for k in range(-3, 6)]
    c = F.col("c")

    def loss(k: float):
        left = F.when(c > 1, F.ln((c - 1 + F.lit(k) * F.exp("log_p")) / F.lit(tokens - 1 + k))).otherwise(F.ln(F.lit(k)) + F.col("log_p") - F.ln(F.lit(tokens - 1 + k)))
        return F.sum(c * left)

    if tokens <= 1:
        return float(max(distinct, 1))
    got = words.where("word <> ''").agg(*[loss(k).alias(str(i)) for i, k in enumerate(grid)]).first()
    return max(zip(grid, got, strict=True), key=lambda x: -math.inf if x[1] is None else x[1])[0]


ROWS = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double, word string, tf long"


def score_documents(docs: DataFrame, model_path: str, doc_id: str = "doc_id", text: str = "text", folds: int = FOLDS) -> DataFrame:
    """The contract's columns for every row of docs; learns from the rows that are not held out.

    Null texts count as empty: one token, the end. Repeated rows are scored, and
    learned from, one by one; rows without an id are learned from. With nothing to
    learn from all counts are 0. Other columns are not read.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), held_out(doc_id, folds).alias("held_out"))
    small_batches(docs.sparkSession)
    plain = written(word_counts(d.where("not held_out")), "words")
    total = plain.agg(F.sum("c"), F.count(F.lit(1))).first()
    tokens, distinct = total[0] or 0, total[1]
    lattice = Lattice.existing(model_path)
    for _ in range(ROUNDS):
        lattice = lattice.refitted(plain.where("word <> ''"))
    shared = spark.sparkContext.broadcast(lattice)

    def by_lattice(batches):
        for b in larger(batches):
            words = b.column("word").to_pylist()
            p = shared.value.log_words(words)
            yield pa.RecordBatch.from_arrays([b.column("word"), b.column("c"), pa.array([x if w else None for w, x in zip(words, p, strict=True)], pa.float64())],
                                             names=["word", "c", "log_p"])

    counts = written(plain.mapInArrow(by_lattice, "word string, c long, log_p double"), "words")
    scorer = spark.sparkContext.broadcast(Scorer(lattice, tokens, distinct, best_strength(counts, tokens, distinct)))

    def scored(batches):
        s = scorer.value
        for b in batches:
            rows = list(zip(*(b.column(c).to_pylist() for c in ("word", "c", "log_p")), strict=True))
            yield pa.RecordBatch.from_arrays([b.column("word"), pa.array([s.base(c) for _, c, _ in rows], pa.float64()),
                                              pa.array([s.model(*r) for r in rows], pa.float64())], names=["word", "base", "model"])

    head = counts.orderBy(F.desc("c"), "word").limit(HEAD_WORDS).repartition(partitions(spark))
    head = head.mapInArrow(scored, "word string, base double, model double").collect()
    known = spark.sparkContext.broadcast({r["word"].encode("utf-8"): (r["base"], r["model"]) for r in head})

    def first_pass(batches):
        head, s = known.value, scorer.value
        end = head.get(b"") or (s.base(0), s.model(END, 0))
        end_known = int(b"" in head)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                row, n, sure, base, model, t_row, t_word, t_tf = part.column("row").to_pylist(), [], [], [], [], [], [], []
                for r, text in zip(row, part.column("text").cast(pa.binary()).to_pylist(), strict=True):
                    seen = Counter(words_of(text))
                    b, m, k, total = end[0], end[1], end_known, 1
                    for w, tf in seen.items():
                        total += tf
                        hit = head.get(w)
                        if hit:
                            b += tf * hit[0]
                            m += tf * hit[1]
                            k += tf
                        else:
                            t_row.append(r)
                            t_word.append(w)
                            t_tf.append(tf)
                    n.append(total)
                    sure.append(k)
                    base.append(b)
                    model.append(m)
                x, y = len(row), len(t_row)
                nulls = lambda k, kind: pa.nulls(k, kind)
                yield pa.RecordBatch.from_arrays([
                    pa.array(row + t_row, pa.int64()), pa.concat_arrays([part.column("doc_id"), nulls(y, pa.int64())]),
                    pa.concat_arrays([part.column("held_out"), nulls(y, pa.bool_())]), pa.array(n + [None] * y, pa.int64()),
                    pa.array(sure + [None] * y, pa.int64()), pa.array(base + [None] * y, pa.float64()), pa.array(model + [None] * y, pa.float64()),
                    pa.concat_arrays([nulls(x, pa.string()), pa.array(t_word, pa.binary()).cast(pa.string())]),
                    pa.array([None] * x + t_tf, pa.int64())], names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "model", "word", "tf"])

    both = written(row_ids(d, "row").mapInArrow(first_pass, ROWS), "scores")
    tail = both.where("word is not null").select("row", "word", "tf")
    tail = tail.join(counts, "word", "left").select("row", "word", "tf", F.coalesce("c", F.lit(0)).alias("c"), "log_p")

    def tail_pass(batches):
        s, kept = scorer.value, {}
        for b in larger(batches):
            tf, c = b.column("tf").to_pylist(), b.column("c").to_pylist()
            words, log_p = b.column("word").to_pylist(), b.column("log_p").to_pylist()
            if len(kept) > TASK_WORDS:
                kept.clear()
            new = list({w for w, p in zip(words, log_p, strict=True) if p is None and w and w not in kept})
            kept.update(zip(new, s.lattice.log_words(new), strict=True))
            model = [s.model(w, k, kept.get(w) if p is None else p) for w, k, p in zip(words, c, log_p, strict=True)]
            yield pa.RecordBatch.from_arrays([
                b.column("row"), pa.array([t if k else 0 for t, k in zip(tf, c, strict=True)], pa.int64()),
                pa.array([t * s.base(k) for t, k in zip(tf, c, strict=True)], pa.float64()),
                pa.array([t * m for t, m in zip(tf, model, strict=True)], pa.float64())], names=["row", "k", "b", "m"])

    sums = tail.mapInArrow(tail_pass, "row long, k long, b double, m double").groupBy("row").agg(
        F.sum("k").alias("k"), F.sum("b").alias("b"), F.sum("m").alias("m"))
    out = both.where("word is null").join(sums, "row", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + zero("k")).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + zero("b")).alias("base_score"), (F.col("model") + zero("m")).alias("score"))


def op8_lattice_lm(docs: DataFrame) -> DataFrame:
    import public_tokenizers as P

    return score_documents(docs, P.path("piece_bpe_32k.model"))
