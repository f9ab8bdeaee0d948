"""Operators against plain versions, round trips and invariants."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.llm import (
    chat, components, decontamination, exact_dedup, near_dedup, packing, pii, quality, sharding, substring_dedup, wordhash,
)

SF = "/root/testdata/sf0.001"


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\té\x0b", max_size=30), max_size=6), st.integers(2, 9))
def test_word_hashes_see_the_same_words(texts, piece):
    old, wordhash.PIECE = wordhash.PIECE, piece
    try:
        hashes, first, last, at = wordhash.word_hashes(pa.array(texts, pa.string()))
    finally:
        wordhash.PIECE = old
    raw = "".join(texts).encode()
    got = [[raw[first[i]:last[i]] for i in range(at[r], at[r + 1])] for r in range(len(texts))]
    assert got == [t.encode().split() for t in texts]
    known = {}
    for h, w in zip(hashes.tolist(), (w for row in got for w in row)):
        assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)


def family(seed=1, copies=60):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    texts = []
    for k in range(copies):
        w = list(base)
        for _ in range(rng.randrange(6)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(9999)}"
        texts.append(" ".join(w))
    texts += [" ".join(f"v{rng.randrange(3000)}" for _ in range(rng.randrange(3, 90))) for _ in range(60)]
    texts += [texts[3], texts[3].upper(), "one two", "one two", "", None, texts[70] + " tail"]
    rng.shuffle(texts)
    return texts


def brute_near(texts, num=85, den=100):
    sets = []
    for t in texts:
        w = words_of(t or "")
        w = [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in w]
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    part = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * (len(sets[i]) + len(sets[j]) - both) and part[i] != part[j]:
                a, b = max(part[i], part[j]), min(part[i], part[j])
                part = [b if p == a else p for p in part]
    return {i: (len(sets[i]), part[i]) for i in range(len(texts))}


@pytest.mark.parametrize("limit, block", [(32, 400_000), (2, 400_000), (2, 900)])
def test_near_duplicates(spark, monkeypatch, limit, block):
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", block)
    texts = family()
    got = near_dedup.near_duplicates(frame(spark, texts), list_limit=limit).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_near(texts)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_ids_with_several_texts_are_one_vertex(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = spark.createDataFrame([(5, a), (9, a), (5, b), (3, b)], "doc_id bigint, text string")
    assert {r["component_id"] for r in near_dedup.near_duplicates(rows).collect()} == {3}


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 360)]
    part = {n: n for pair in links for n in pair}
    for a, b in links:
        x, y = part[a], part[b]
        part = {n: min(x, y) if p in (x, y) else p for n, p in part.items()}
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert all(got.get(n, n) == p for n, p in part.items())


def brute_repeats(texts):
    lists = [words_of(t or "") for t in texts]
    first = {}
    for i, w in enumerate(lists):
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k:k + 13]), i)
    out = {}
    for i, w in enumerate(lists):
        gone = {p for k in range(len(w) - 12) if first[tuple(w[k:k + 13])] < i for p in range(k, k + 13)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("hot", [250_000, 3])
def test_remove_repeats(spark, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT_ROWS", hot)
    monkeypatch.setattr(substring_dedup, "LEAST_COMMON", 3)
    rng = random.Random(2)
    shared = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 3) for _ in range(rng.randrange(10, 60))) for _ in range(12)]
    texts = []
    for _ in range(120):
        parts = [rng.choice(shared) if rng.random() < 0.5 else " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(25))) for _ in range(4)]
        texts.append(rng.choice([" ", "\n", "  "]).join(parts))
    texts += [texts[0], "", None, " ".join(texts[:3])]
    got = substring_dedup.remove_repeats(frame(spark, texts)).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == brute_repeats(texts)


def plain_parse(lists, docs):
    """Greedy factors and runs over factor ends, against every word list of an earlier document."""
    def longest(i, p):
        best = (0, 0)
        for j, other in enumerate(lists):
            if docs[j] < docs[i]:
                for q in range(len(other)):
                    n = 0
                    while p + n < len(lists[i]) and q + n < len(other) and lists[i][p + n] == other[q + n]:
                        n += 1
                    best = max(best, (n, -docs[j]))
        return best

    factors, covered = [], []
    for i, words in enumerate(lists):
        p, gone = 0, set()
        while p < len(words):
            n, doc = longest(i, p)
            stop = p + max(n, 1)
            for q in [p, *range(max(p + 1, stop - 12), stop)]:
                m, doc = longest(i, q)
                if m >= 13:
                    factors.append((i, q, q + m, -doc))
                    gone |= set(range(q, q + m))
            p = stop
        covered.append(gone)
    return sorted(factors), covered


@pytest.mark.parametrize("seed", range(4))
def test_factors_of_a_block_equal_a_plain_greedy_parse(seed):
    rng = random.Random(seed)
    shared = [[rng.randrange(9) for _ in range(rng.randrange(14, 40))] for _ in range(5)]
    lists, docs = [], []
    for _ in range(24):
        words = []
        for _ in range(3):
            one = rng.choice(shared)
            words += one[rng.randrange(5):len(one) - rng.randrange(5)] if rng.random() < 0.7 else [rng.randrange(9)]
        lists.append(words)
        docs.append(rng.randrange(12))
    end = np.cumsum([len(w) for w in lists])
    begin = end - [len(w) for w in lists]
    ids, owner = np.concatenate(lists), np.repeat(docs, end - begin)
    left = np.repeat(end, end - begin) - np.arange(len(ids))
    f, a, e, ref = substring_dedup.greedy_factors(begin, end, *substring_dedup.longest_earlier(ids, left, owner))
    expected, covered = plain_parse(lists, docs)
    assert sorted(zip(f.tolist(), (a - begin[f]).tolist(), (e - begin[f]).tolist(), ref.tolist())) == expected and expected
    # Nothing that repeats is lost at the ends of factors.
    for i, words in enumerate(lists):
        windows = {tuple(w[k:k + 13]) for w, d in zip(lists, docs) if d < docs[i] for k in range(len(w) - 12)}
        assert covered[i] == {p for k in range(len(words) - 12) if tuple(words[k:k + 13]) in windows for p in range(k, k + 13)}


def test_fragments_hold_every_wanted_window_once():
    anchors = np.array([5, 5, 5, 7, 7, 5, 9, 9] + [4] * 150, np.uint64)
    wanted, alone = anchors != 7, anchors == 9
    begin, n = substring_dedup.fragments(anchors, wanted, alone)
    assert begin.tolist() == [0, 5, 6, 7, 8, 72, 136] and n.tolist() == [3, 1, 1, 1, 64, 64, 22]
    assert [len(x) for x in substring_dedup.fragments(anchors, anchors == 3, alone)] == [0, 0]


def test_long_words_are_compared_by_digest():
    joined, first, last = substring_dedup._split([b"a", b"x" * 5000, b"b"])
    assert joined[first[0]:last[0]] == b"a" and joined[first[2]:last[2]] == b"b" and last[1] - first[1] == 65
    assert substring_dedup._split([b"a", b"b"])[0] == b"a b" and substring_dedup._split([])[0] == b""


@pytest.mark.parametrize("cut, block", [(2, 5), (20_000, 7), (1, 20_000)])
def test_repeats_do_not_depend_on_blocks(spark, monkeypatch, cut, block):
    monkeypatch.setattr(substring_dedup, "CUT_ROWS", cut)
    monkeypatch.setattr(substring_dedup, "BLOCK_ROWS", block)
    test_remove_repeats(spark, monkeypatch, 250_000)


@pytest.mark.parametrize("keep", ["max", "min"])
@pytest.mark.parametrize("hot", [2, 512])
def test_exact_duplicates_with_hot_groups(spark, hot, keep):
    rng = random.Random(3)
    texts = [rng.choice(["a", "a b", "", None, "c" * 500]) if rng.random() < 0.7 else f"t{i}" for i in range(200)]
    docs = frame(spark, texts)
    groups = defaultdict(list)
    for i, t in enumerate(texts):
        groups[t or ""].append(i)
    pick = max if keep == "max" else min
    want = {i: (pick(g), len(g), i == pick(g)) for g in groups.values() for i in g}
    got = exact_dedup.exact_duplicates(docs, keep=keep, hot_rows=hot).collect()
    assert {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in got} == want
    left = exact_dedup.drop_exact_duplicates(docs, keep=keep, hot_rows=hot).collect()
    assert sorted((r["doc_id"], r["text"]) for r in left if r["text"] is not None) == sorted(
        (pick(g), texts[pick(g)]) for g in groups.values() if texts[pick(g)] is not None)
    assert len(left) == len(groups)


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 9), min_size=1, max_size=12))
def test_bin_completion_packs_everything(counts):
    plan = packing.complete_bins(counts, 64, nodes=500)
    used = Counter()
    for filling, m in plan:
        assert sum(filling) <= 64
        for n in filling:
            used[n] += m
    assert used == Counter(counts)
    bins = sum(m for _, m in plan)
    assert packing.lower_bound(counts, 64) <= bins <= sum(m for _, m in packing.best_fit(counts, 64))


def test_bin_completion_beats_best_fit():
    # Best fit decreasing needs three sequences here, two suffice.
    counts = dict(Counter([44, 24, 24, 22, 21, 17, 8, 8, 6, 6, 20]))
    assert sum(m for _, m in packing.complete_bins(counts, 100)) == 2


def test_dominance():
    assert packing.dominates((6,), (3, 2)) and not packing.dominates((3, 2), (6,))
    assert packing.dominates((5, 4), (4, 3, 1))


def test_pack(spark):
    from tokenizers import Tokenizer
    import public_tokenizers
    import zlib

    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    rows = [r for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    texts = [r["text"] for r in rows] + ["", "a<|endoftext|>b  C\tD e　f", "É é ﬁ 's it's"]
    got = packing.pack(frame(spark, texts), capacity=256).collect()
    want = {}
    for i, t in enumerate(texts):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for p, at in enumerate(range(0, len(ids), 256)):
            want[i, p] = (at, len(ids[at:at + 256]), zlib.crc32(ids[at:at + 256].tobytes()))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 256
    counts = dict(Counter(w[1] for w in want.values()))
    assert packing.lower_bound(counts, 256) <= len(sequences) <= 1.005 * packing.lower_bound(counts, 256)
    # A tokenizer that merges across words is used on whole texts.
    other = public_tokenizers.path("byte_bpe_50k.json")
    assert not packing.Encoder(other).by_word
    assert next(packing.Encoder(other).encode(["a b"])) == packing.Encoder(other).whole("a b")


def test_hypergeometric_follows_its_law():
    rng = np.random.default_rng(1)
    draws = np.array([sharding.hypergeometric(rng, 50, 20, 12) for _ in range(4000)])
    want = np.random.default_rng(2).hypergeometric(20, 30, 12, 4000)
    assert abs(draws.mean() - 4.8) < 0.1 and abs(draws.var() - want.var()) < 0.25
    big = [sharding.hypergeometric(rng, 10**11, 10**11 // 40, 24_000_000) for _ in range(200)]
    assert abs(np.mean(big) - 600_000) < 300 and 500 < np.std(big) < 1100


def test_shards(spark):
    docs = spark.range(3001).select(F.col("id").alias("doc_id"), F.concat(F.lit("é"), F.col("id")).alias("text"))
    rows = sharding.shuffle_into_shards(docs, shards=7, source_rows=500, block_rows=64).collect()
    shards = defaultdict(list)
    for r in rows:
        shards[r["shard"]].append((r["slot"], r["doc_id"]))
        assert r["size"] == 16 + 2 + len(str(r["doc_id"])) and r["law"] == "rows" and r["grown_shard"] is None
    assert sorted(map(len, shards.values())) == sorted(sharding.shard_sizes(3001, 7))
    assert all(sorted(s for s, _ in v) == list(range(len(v))) for v in shards.values())
    assert sorted(d for v in shards.values() for _, d in v) == list(range(3001))
    again = sharding.shuffle_into_shards(docs, shards=7, source_rows=500, block_rows=64).collect()
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in rows} == {(r["doc_id"], r["shard"], r["slot"]) for r in again}
    # Neighbouring ids land in the same shard as often as chance has it, and order is lost.
    at = {d: (k, s) for k, v in shards.items() for s, d in v}
    together = np.mean([at[i][0] == at[i + 1][0] for i in range(3000)])
    assert abs(together - 1 / 7) < 0.03
    assert abs(np.corrcoef([d for _, d in sorted(shards[0])], range(len(shards[0])))[0, 1]) < 0.2


TEXTS = st.lists(st.sampled_from([*"ab <>[]/\\\n012é", "</s>", "[INST]", "[/INST]", "<<SYS>>", "[TEXT]", "<s> "]), max_size=25).map("".join)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "to[TEXT]ol", ""]), TEXTS), min_size=1, max_size=12))
def test_chat_round_trip(spark, turns):
    given_ = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(turns)], "conv_id bigint, turn bigint, role string, text string")
    row = chat.assemble(chat.format_turns(given_)).select(
        chat.parse_turns(F.col("formatted")).alias("back"), chat.loss_text(F.col("segments")).alias("loss"), "formatted").first()
    assert [(t["role"], t["text"]) for t in row["back"]] == turns
    assert row["loss"] == "".join(t for r, t in turns if r == "assistant")


def test_turn_order(spark):
    orders = {1: "system user assistant user assistant", 2: "user assistant user", 3: "assistant user", 4: "user user assistant", 5: "user system"}
    rows = [(c, i, r, "x") for c, order in orders.items() for i, r in enumerate(order.split())]
    made = chat.format_turns(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    legal = defaultdict(list)
    for r in made.orderBy("conv_id", "position").collect():
        legal[r["conv_id"]].append(r["legal"])
    assert legal == {1: [True] * 5, 2: [True] * 3, 3: [False, True], 4: [True, False, True], 5: [True, False]}
    assert {r["conv_id"]: r["valid"] for r in chat.assemble(made).collect()} == {1: True, 2: False, 3: False, 4: False, 5: False}


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    out = {}
    for kind, pattern in PATTERNS.items():
        out[kind] = []
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out[kind].append(m.span())
    return out


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a.@-+ 0129()\n", max_size=60))
def test_base_spans(text):
    assert pii.base_spans(text) == brute_spans(text)


def test_luhn():
    assert pii.luhn("4539578763621486") and not pii.luhn("4539578763621487")


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(0)
    field = pii.Field({}, np.zeros((1, len(pii.TAGS))), rng.normal(size=(9, 9)))
    field.weight = rng.normal(size=(6, 9))
    rows = [rng.integers(0, 6, (n, 2)) for n in (1, 3, 4)]
    for row, tags in zip(rows, field.decode(rows)):
        def score(path):
            if not pii.FIRST[path[0]] or any(not pii.ALLOWED[a, b] for a, b in zip(path, path[1:])):
                return -np.inf
            return sum(field.weight[r].sum(0)[t] for r, t in zip(row, path)) + sum(field.step[a, b] for a, b in zip(path, path[1:]))
        paths = np.stack(np.meshgrid(*[range(9)] * len(row), indexing="ij"), -1).reshape(-1, len(row))
        assert np.isclose(score(tags), max(score(p) for p in paths))


def test_quality_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    trees = quality.fit_quality(docs, labels)
    rows = quality.score_quality(docs, trees).join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 40 and np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.9
    kept = {r["doc_id"] for r in quality.keep_quality(docs, trees).collect()}
    assert kept == {r["doc_id"] for r in quality.score_quality(docs, trees).filter("predicted = 1").collect()}


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(3)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    trees = quality.train(x[:1500], y[:1500])
    assert np.mean((trees.score(x[1500:]) > 0.5) == y[1500:]) > 0.95


def test_decontamination_recall(spark):
    rng = random.Random(4)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    items = {r["item_id"]: re.findall(r"\w+", r["text"].lower()) for r in benchmark.collect()}
    index = defaultdict(set)
    for item, w in items.items():
        for k in range(len(w) - 7):
            index[tuple(w[k:k + 8])].add(item)
    rows = docs.collect()
    want = set()
    for r in rows:
        w = re.findall(r"\w+", (r["text"] or "").lower())
        want |= {(r["doc_id"], item) for k in range(len(w) - 7) for item in index.get(tuple(w[k:k + 8]), ())}
    dirty = {d for d, _ in want}
    clean = [r["text"] for r in rows if r["doc_id"] not in dirty and len(r["text"]) > 1500][:60]
    vocabulary = " ".join(clean[:20]).split()
    planted = []
    for k, text in enumerate(clean):
        item = list(items)[k % len(items)]
        w = [rng.choice(vocabulary) if rng.random() < 0.1 else x for x in items[item]]
        z = text.split()
        at = rng.randrange(len(z))
        planted.append((100_000 + k, " ".join([*z[:at], *w, *z[at:]]), item))
    more = docs.unionByName(spark.createDataFrame([p[:2] for p in planted], "doc_id bigint, text string"))
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.find_contaminated(more, benchmark).collect()}
    truth = want | {(d, item) for d, _, item in planted}
    assert len(got & truth) >= 0.95 * len(truth)
    assert want <= got and not {d for d, _ in got} - {d for d, _ in truth}


def test_common_words_is_the_longest_common_subsequence():
    rng = np.random.default_rng(6)
    for _ in range(50):
        a, b = rng.integers(0, 6, rng.integers(1, 30)), rng.integers(0, 6, rng.integers(1, 20))
        best = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1, j + 1] = best[i, j] + 1 if x == y else max(best[i, j + 1], best[i + 1, j])
        assert decontamination.common_words(a.astype(np.uint64), b.astype(np.uint64)) == best[-1, -1]
