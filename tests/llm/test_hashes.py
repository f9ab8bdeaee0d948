"""Word hashes on words that sum up alike, and what rests on them."""

import numpy as np
import pyarrow as pa

from shelfmark.llm import near_dedup, substring_dedup
from shelfmark.llm.wordhash import word_hashes


def thue_morse(letters, n):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


ONE, OTHER = thue_morse("ab", 2048), thue_morse("ba", 2048)


def test_hashes_tell_words_apart():
    words = [thue_morse("ab", n) for n in range(1, 300)] + [thue_morse("ba", n) for n in range(1, 300)] + [ONE, OTHER]
    words += ["a" * n for n in range(2, 400)] + ["a" * n + "\0" for n in range(2, 20)]
    for seed in (0, 1):
        hashes, first, last, at = word_hashes(pa.array([" ".join(words)] * 2 + [None, ""]), seed=seed)
        n = len(words)
        assert len(set(hashes[:n].tolist())) == len(set(words))
        assert (hashes[:n] == hashes[n:]).all() and at.tolist() == [0, n, 2 * n, 2 * n, 2 * n]
    one, two = (word_hashes(pa.array([" ".join(words)]), seed=s)[0] for s in (0, 1))
    assert not (one == two).any()


def test_the_hash_of_a_word_is_the_same_wherever_it_stands():
    alone = word_hashes(pa.array(["somewhat"]))[0][0]
    for before in range(9):
        hashes, first, last, _ = word_hashes(pa.array(["x" * before + " Somewhat, somewhat " + "y" * 70]), lower=True)
        assert hashes[-2] == alone and hashes[-3] != alone
    long = "z" * 5000
    assert len(set(word_hashes(pa.array([long, "a " + long, long + " b"]))[0].tolist())) == 3


def test_complements_are_no_repeat_and_no_link(spark):
    rest = "two three four five six seven eight nine ten eleven twelve thirteen"
    docs = spark.createDataFrame([(1, f"{ONE} {rest}"), (2, f"{OTHER} {rest}"), (3, f"{ONE} {rest}")], "doc_id bigint, text string")
    rows = {r["doc_id"]: r["n_removed"] for r in substring_dedup.remove_repeats(docs).collect()}
    assert rows == {1: 0, 2: 0, 3: 13}
    short = spark.createDataFrame([(1, f"{ONE} a b c d e f g h i"), (2, f"{OTHER} a b c d e f g h i")], "doc_id bigint, text string")
    assert {r["component_id"] for r in near_dedup.near_duplicates(short).collect()} == {1, 2}


def test_text_keys_have_128_bits():
    assert all(-(1 << 63) <= k < 1 << 63 for k in substring_dedup._keys(b"some words"))
    assert substring_dedup._keys(b"a  b\tc") == substring_dedup._keys(b"a b c") != substring_dedup._keys(b"a bc")
    assert np.unique([substring_dedup._keys(str(i).encode()) for i in range(1000)], axis=0).shape == (1000, 2)
