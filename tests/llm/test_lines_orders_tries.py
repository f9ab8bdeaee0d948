"""Line dedup, filter audit and prefix trie: parts against plain versions, and edge cases."""

import hashlib
import random
import zlib
from collections import defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import filter_audit, line_dedup, prefix_trie
from shelfmark.llm.perfect_hash import PerfectHash
from shelfmark.llm.radix_tree import RadixTree

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, h bigint, shard bigint, part string, mask int, doc bigint"
LONG = "\n".join(f"line number {i % 5000} of a very long text" for i in range(20_000))
TEXTS = [
    (1, "A line that many documents share\nshort\nown line of the first document"),
    (2, "  a LINE that many documents share\t\nshort\nown line of the second document"),
    (3, "a line that many documents share\na line that many documents share\n\nshort"),
    (2, "a line that many documents share"), (None, "a line that many documents share\nno id here at all, no"),
    (4, None), (5, ""), (6, LONG), (7, LONG), (8, LONG + "\n"), (None, None), (9, "\n\n"), (10, "äöü äöü äöü äöü äöü"),
    (11, "äöü äöü äöü äöü äöüß"), (12, "äöü äöü äöü äöü äöüß"), (13, "ÄÖÜ äöü äöü äöü äöüß"), (14, "äöü äöü äöü äöü äöüß"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, None, "s" if i != 3 else None, None, 1, 1, "x", 9, 1) for i, t in TEXTS], DOCS)


def brute_lines(rows, documents=3, shortest=20):
    def key(line):
        k = line.strip(" \t\n\v\f\r")
        return "".join(c.lower() if c.isascii() else c for c in k) if len(k) >= shortest else None

    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if key(line) is not None:
                holders[key(line)].add(-1 if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if key(x) is None or len(holders[key(x)]) < documents or max(holders[key(x)]) == (-1 if i is None else i)]
        out.append((str(i), len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out)


def test_lines_against_plain_version(docs, monkeypatch):
    got = [tuple(r) for r in line_dedup.drop_repeated_lines(docs).collect()]
    assert sorted((str(i), *rest) for i, *rest in got) == brute_lines(TEXTS)
    assert line_dedup.drop_repeated_lines(docs.limit(0)).count() == 0
    # Many small shards, hot ones copied.
    monkeypatch.setattr(line_dedup, "SHARD_LINES", 40)
    monkeypatch.setattr(line_dedup, "HOT", 1)
    got = [tuple(r) for r in line_dedup.drop_repeated_lines(docs, 2).collect()]
    assert sorted((str(i), *rest) for i, *rest in got) == brute_lines(TEXTS, 2)


def test_foreign_lines_find_nothing(spark):
    known = spark.createDataFrame([(i, f"a known line with number {k}") for i in range(3) for k in range(500)], "doc_id bigint, text string")
    other = spark.createDataFrame([(9, "\n".join(f"another line with number {k}" for k in range(5000)) + "\na known line with number 7")],
                                  "doc_id bigint, text string")
    counts = line_dedup.line_counts(line_dedup.document_lines(known))
    loads = spark.createDataFrame([(s, 100) for s in range(3)], "shard bigint, load bigint")
    index = line_dedup.build_shards(counts, 3)
    lost = line_dedup.probe_shards(line_dedup.document_lines(other), index, loads, 3)
    want = np.frombuffer(line_dedup.line_digest(b"a known line with number 7"), np.int64)
    assert [(r["h"], r["g"]) for r in lost.collect()] == [tuple(want.tolist())]


def test_perfect_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 100, 50_000):
        h, g = (rng.integers(0, 1 << 63, n, np.uint64) for _ in "hg")
        h[:n // 2] = 7  # one half alone does not tell keys apart
        made = PerfectHash.from_bytes(PerfectHash.build(h, g).to_bytes())
        assert sorted(made.numbers(h, g).tolist()) == list(range(n))
        assert 8 * len(made.to_bytes()) < 6 * n + 4096
        foreign = made.numbers(g, h + np.uint64(1))
        assert foreign.max(initial=-1) < n


def test_perfect_hash_lists_what_no_level_settles(monkeypatch):
    monkeypatch.setattr("shelfmark.llm.perfect_hash.LEVELS", 1)
    h, g = np.arange(1000, dtype=np.uint64), np.arange(1000, dtype=np.uint64)[::-1].copy()
    made = PerfectHash.from_bytes(PerfectHash.build(h, g).to_bytes())
    assert len(made.rest) and sorted(made.numbers(h, g).tolist()) == list(range(1000))
    assert (made.numbers(h + np.uint64(5000), g) < 1000).all()


# --- filter audit --------------------------------------------------------------------------------

LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, None), (3, None, None), (None, 1, 1), (6, 1, 1), (99, 1, 1)]


def brute_audit(rows, labels):
    """(part, order, step) -> figures, document by document."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    order = lambda i: float("inf") if i is None else i
    least = {}
    for i, t, _ in rows:
        least[t or ""] = min(least.get(t or "", float("inf")), order(i))
    found = []
    for i, t, source in rows:
        t = t or ""
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", t) if w]
        bad = {"A"} if len(words) < 200 else set()
        bad |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        bad |= {"C"} if 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t) else set()
        bad |= {"D"} if set(t) & set("#$%&*|") else set()
        bad |= {"E"} if order(i) > least[t] else set()
        found.append((source or "", bad, i in good, i in toxic))
    out = {}
    for part in {p for p, *_ in found}:
        own = [r for r in found if r[0] == part]
        shapley = defaultdict(int)
        for names in permutations("ABCDE"):
            for step, f in enumerate(names, 1):
                before, now = set(names[:step - 1]), set(names[:step])
                removed = [r for r in own if f in r[1] and not r[1] & before]
                shapley[f] += len(removed)
                out[part, "".join(names), step] = [
                    sum(not r[1] & now for r in own), len(removed), sum(f in r[1] and bool(r[1] & before) for r in own),
                    sum(r[1] == {f} for r in own), sum(r[2] for r in removed), sum(r[3] for r in removed)]
        for (p, names, step), row in out.items():
            if p == part:
                row.append(shapley[names[step - 1]])
    return out


def test_audit_against_plain_version(spark, docs):
    extra = [(20 + k, text, source) for k, (text, source) in enumerate(
        [("word " * 300, "t"), ("word " * 300, "s"), (" ".join(f"w{i}" for i in range(250)), ""), (" ".join(f"w{i}" for i in range(250)) + " #", "t"),
         ("A B C", "t"), ("A B C", "s"), ("A B C", None)])]
    more = docs.select("doc_id", "text", "source", "part", "mask").unionByName(
        spark.createDataFrame(extra, "doc_id bigint, text string, source string"), allowMissingColumns=True)
    labels = spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int")
    spark.conf.set(filter_audit.ROW_LIMIT, "50")
    try:
        rows = filter_audit.audit_filters(more, labels).collect()
    finally:
        spark.conf.unset(filter_audit.ROW_LIMIT)
    given = [(i, t, "s" if i != 3 else None) for i, t in TEXTS] + extra
    assert {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in rows} == brute_audit(given, LABELS)
    assert len(rows) == 600 * 3
    assert filter_audit.audit_filters(docs.limit(0), labels).count() == 0
    assert filter_audit.audit_filters(docs, labels.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


# --- prefix trie ---------------------------------------------------------------------------------

def test_radix_tree_in_all_layouts():
    rng = random.Random(3)
    keys = {bytes(rng.choice((0, 255, rng.randrange(256))) for _ in range(rng.choice((0, 2, 4, 6)))) for _ in range(4000)}
    keys |= {bytes([7, k]) for k in range(256)} | {bytes([8, k]) for k in range(40)} | {bytes([9, k]) for k in range(12)}
    tree = RadixTree()
    order = sorted(keys, key=lambda k: zlib.crc32(k))
    for k in order:
        tree.insert(k, k)
    assert all(tree.get(k) == k for k in keys)
    assert tree.get(b"\x07\x07\x07") is None and tree.get(b"\x08\xff") is None
    seen = [node.value for node, _, _ in tree.bottom_up() if node.value is not None]
    assert sorted(seen) == sorted(keys)
    assert {node.layout for node, _, _ in tree.bottom_up()} == {4, 16, 48, 256}
    assert sum(1 for _ in tree.bottom_up()) <= 2 * len(keys)


def brute_trie(lists):
    """Nodes of {conv_id: [(role, text), ...]} as tuples, root included."""
    members = defaultdict(list)
    for c, turns in lists.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in children[p]) or 1
        saved[p] = sum(saved[k] for k in children[p]) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    out = []
    for p, own in members.items():
        ends = ",".join(map(str, sorted(c for c in own if len(lists[c]) == len(p))))
        out.append((min(own), len(p), min(members[p[:-1]]) if p else None, len(own), len(children[p]), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rebuild(given):
    out = {}
    for c, turns in given.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = given.get(c - c % 5, [])[:h] + turns[h:]
    return out


def some_conversations(n, seed):
    rng = random.Random(seed)
    turns = [("system", "be kind"), ("user", "hällo"), ("assistant", "hi"), ("user", "x" * 50), ("", "")]
    return {c: [rng.choice(turns[:1 + (k > 0) * 4]) for k in range(rng.randrange(1, 12))] for c in range(n) if rng.random() < 0.9}


def frame(spark, given):
    rows = [(c, k if k else None, r or None, t or None, "x", "y") for c, turns in given.items() for k, (r, t) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, digest string, top string")


@pytest.mark.parametrize("least", [1, 3, 1000])
def test_trie_against_plain_version(spark, least):
    given = some_conversations(150, least)
    lists = prefix_trie.rebuilt(prefix_trie.turn_lists(frame(spark, given)))
    got = prefix_trie.trie(lists, least).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_trie(rebuild(given))


def test_trie_without_rebuilding(spark):
    given = some_conversations(60, 9) | {1000: [("user", f"turn {k}") for k in range(700)], 1001: [("user", f"turn {k}") for k in range(650)]}
    got = prefix_trie.prefix_trie(frame(spark, given), rebuild=False).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_trie(given)


def test_trie_edges(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, node string"
    rows = [(None, 0, "user", "lost", "n"), (3, None, None, None, "n"), (3, 0, "user", "a", "n"), (3, 0, "user", "a", "n"),
            (-7, 0, "user", "b", "n"), (4, 0, "ab", "c", "n"), (6, 0, "a", "bc", "n"), (8, 1, "user", "t" * 1_000_000, "n")]
    given = spark.createDataFrame(rows, schema)
    lists = {3: [("", ""), ("user", "a"), ("user", "a")], -7: [("user", "b")], 4: [("ab", "c")], 6: [("a", "bc")], 8: [("user", "t" * 1_000_000)]}
    got = prefix_trie.prefix_trie(given, rebuild=False).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_trie(lists)
    alone = prefix_trie.prefix_trie(given).collect()
    want = {c: t[zlib.crc32(str(c).encode()) % 9:] for c, t in lists.items()}  # no group has its first conversation
    assert sorted((tuple(r) for r in alone), key=str) == brute_trie(want)
    assert prefix_trie.prefix_trie(given.limit(0)).count() == 0
