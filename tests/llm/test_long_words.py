"""Pre-tokens of millions of characters: the trie's counts, in bounded memory."""

import tracemalloc

import numpy as np

from terraline.llm import tokencount

SCORES = {tokencount.MARK: -3.0, "a": -2.0, "b": -2.5, "ab": -3.0, tokencount.MARK + "a": -2.5, "bab": -4.0, "é": -5.0}


def test_a_long_word_is_counted_as_in_the_trie(monkeypatch):
    rng = np.random.default_rng(0)
    words = ["".join(rng.choice(list("abéz日"), n)).encode() for n in (1, 2, 3, 40, 95, 300)]
    times = np.arange(1, 7)
    whole = tokencount.UnigramTrie(SCORES)
    monkeypatch.setattr(tokencount, "DEEP", 10_000)
    counts, used = whole.count_words(words), whole.use(words, times)
    monkeypatch.setattr(tokencount, "DEEP", 0)
    assert whole.count_words(words).tolist() == counts.tolist() and whole.use(words, times).tolist() == used.tolist() and used.sum() > 0


def test_a_long_word_takes_little_more_than_itself():
    trie = tokencount.UnigramTrie(SCORES)
    word = "ab" * 150_000
    total = np.zeros(len(SCORES), np.int64)
    tracemalloc.start()
    n = trie.one(word, total, 2)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == total.sum() // 2 and most < 4 * len(word)
