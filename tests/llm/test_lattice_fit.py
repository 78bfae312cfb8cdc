"""The fit of op8's lattice: rounds, and words of every length."""

import math

import numpy as np
import public_tokenizers as P
import pytest

from offblock.llm import lattice_lm


def test_shipped_rounds_fit_better_than_one(spark):
    start = lattice_lm.Lattice.existing(P.path("piece_bpe_32k.model"))
    words = ["the", "there", "other", "another", "thereon", "reand", "thander", "onther", "errand", "anon"]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    fits = [start]
    for _ in range(max(lattice_lm.ROUNDS, 1)):
        fits.append(fits[-1].refitted(df))
    assert sum(fits[-1].log_words(words)) > sum(fits[1].log_words(words)) + 0.1


@pytest.mark.parametrize("word", ["there", "é🙂x", "otherthing"])
def test_long_path_equals_the_block_path(word):
    lattice = lattice_lm.Lattice.existing(P.path("piece_bpe_32k.model"))
    one, two = lattice_lm.Counts(len(lattice.vocab)), lattice_lm.Counts(len(lattice.vocab))
    lattice.expected([word], one)
    lattice.expected_long(word, two)
    assert np.allclose(one.flat(), two.flat())


def test_long_and_improbable_words_are_fitted_on(spark):
    start = lattice_lm.Lattice.existing(P.path("piece_bpe_32k.model"))
    counts = lattice_lm.Counts(len(start.vocab))
    start.expected(["\U0001f9ff" * 40, "\U0001f9fe" * 40], counts)  # their probabilities are beyond doubles
    assert counts.words == 2 and counts.first.sum() + counts.first_bytes.sum() == pytest.approx(2)
    words = ["there" * 30, "onother" * 900]
    fit = start.refitted(spark.createDataFrame([(w,) for w in words], "word string"))
    assert all(math.isfinite(x) for x in fit.log_words(words)) and sum(fit.log_words(words)) > sum(start.log_words(words)) + 1000


def test_words_of_one_length_are_not_looked_up_text_by_text():
    lattice = lattice_lm.Lattice.existing(P.path("piece_bpe_32k.model"))
    words = ["there", "other", "thand", "é🙂x ñ", "\x00abc\x00", "~~~~�"]
    want, alone = [lattice.log_word(w) for w in words], lattice_lm.Counts(len(lattice.vocab))
    for w in words:
        lattice.expected_long(w, alone)

    class NoLookups(dict):
        def get(self, *_):
            raise AssertionError("one lookup a text")

    lattice.id, counts = NoLookups(lattice.id), lattice_lm.Counts(len(lattice.vocab))
    assert np.allclose(lattice.log_words(words), want, rtol=1e-12)
    lattice.expected(words, counts)
    assert np.allclose(counts.flat(), alone.flat(), rtol=1e-9, atol=1e-12)
    assert lattice.log_words(["", ""]) == [lattice.log_end] * 2
