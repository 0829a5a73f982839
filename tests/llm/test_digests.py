"""Texts that collide under any polynomial hash modulo 2 ** 64 are told apart by operators 2, 5 and 10."""

import numpy as np
import pytest
from tokenizers import Tokenizer

from claimloom.llm.common import span_digests, span_hashes
from claimloom.llm.ngram_join import ngram_jaccard_join
from claimloom.llm.packing import WordTokenizer, default_vocabulary
from claimloom.llm.substring_dedup import repeats_by_document


def thue_morse(length):
    one = "".join("ab"[bin(i).count("1") & 1] for i in range(length))
    return one, one.translate(str.maketrans("ab", "ba"))


def digests(texts, seed=0):
    raw = [t.encode() for t in texts]
    ends = np.cumsum([len(t) for t in raw])
    return span_digests(np.frombuffer(b"".join(raw), np.uint8), ends - [len(t) for t in raw], ends, seed)


@pytest.mark.parametrize("length", [1024, 2048, 4096, 8192])
def test_digests_of_thue_morse_words(length):
    pair = thue_morse(length)
    raw = "".join(pair).encode()
    old = span_hashes(np.frombuffer(raw, np.uint8), np.array([0, length]), np.array([length, 2 * length]))
    assert old[0] == old[1]
    assert len(set(digests(pair).tolist())) == 2


def test_digests_depend_on_bytes_and_seed_alone():
    rng = np.random.default_rng(3)
    texts = ["", "a", "aa", "a" * 8, "a" * 9, "a\0", "x" * 600, "x" * 601, *("".join(rng.choice(list("ab"), rng.integers(1, 700))) for _ in range(300))]
    first, again = digests(texts), digests(texts[::-1])[::-1]
    assert (first == again).all() and len(set(first.tolist())) == len(set(texts))
    assert not set(first.tolist()) & set(digests(texts, 1).tolist())


def test_operators_tell_thue_morse_words_apart(frame):
    a, b = thue_morse(2048)
    rows = [(1, a, "en", "x"), (2, b, "en", "x"), (3, a, "en", "x")]
    assert {r.doc_id: r.component_id for r in ngram_jaccard_join(frame(rows), 3, (9, 10)).collect()} == {1: 1, 2: 2, 3: 1}
    words = [" ".join([t] * 60) for t in thue_morse(1024)]
    assert repeats_by_document(frame([(1, words[0], "en", "x"), (2, words[1], "en", "x")])).count() == 0
    assert [r.doc_id for r in repeats_by_document(frame([(1, words[0], "en", "x"), (2, words[0], "en", "x")])).collect()] == [2]
    tokenizer, library = WordTokenizer(default_vocabulary()), Tokenizer.from_file(default_vocabulary())
    for _ in range(2):  # the second time from the cache
        for text in (a, b, f"{b} {a}"):
            raw = text.encode()
            ids, counts = tokenizer.encode(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids and counts.tolist() == [len(ids)]
