"""Language ID of text without blanks: every letter counts."""

import random

from offblock.llm import language_id


def grams(word):
    return {word[i : i + k] for k in (2, 3) for i in range(len(word) - k + 1)}


def test_pieces_cover_all_letters_and_grams():
    r = random.Random(8)
    for n in (1, 2, 24, 25, 26, 27, 46, 47, 48, 49, 1000):
        word = "".join(r.choice("abcdefgh") for _ in range(n))
        pieces = language_id.tokens_of(word)
        assert max(map(len, pieces)) <= language_id.WIDTH and pieces[0] + "".join(x[language_id.OVERLAP :] for x in pieces[1:]) == word
        assert set().union(*map(grams, pieces)) == grams(word)
    assert language_id.tokens_of("a 12 " + "-" * 40 + " b") == ["a", "12", "-" * 40, "b"] and language_id.tokens_of(None) == []


def test_features_of_a_long_word_come_from_all_letters():
    word = "a" * 15 + "bcd" + "a" * 15
    with_middle, without = ({int(x) for _, f in language_id.features([w]) for x in f} for w in (word, "a" * 33))
    assert len(with_middle - without) >= 8  # the word, ab bc cd da, aab abc bcd cda daa


def test_text_without_blanks_is_judged_by_its_middle(spark):
    r = random.Random(9)
    word = lambda s, n: "".join(r.choice(s) for _ in range(n))
    rows = [(i, " ".join(word("abcd", 6) for _ in range(40)), "x") for i in range(40)] + [(100 + i, " ".join(word("wyzv", 6) for _ in range(40)), "y") for i in range(40)]
    odd = [(200, word("abcd", 12) + word("wyzv", 3000) + word("abcd", 12)), (201, "abca " * 5 + word("wyzv", 3000))]
    field = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    got = {x.doc_id: x for x in language_id.predict(spark.createDataFrame(odd, "doc_id long, text string"), field).collect()}
    assert {i: x.lang_pred for i, x in got.items()} == {200: "y", 201: "y"} and got[201].score > 0.9
