"""Prefix trie, lexical search and Jaccard join against brute force, on odd rows and on hot groups."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from invoice_lake.llm import jaccard_join, lexical_search, prefix_trie
from invoice_lake.llm.components import forest
from tests.conftest import SF_DIR

FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
BLANK = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_trie(sequences):
    """Nodes of {conv_id: [(role, text), ...]} as tuples, from dictionaries of prefixes."""
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = collections.Counter(n[:-1] for n in members if n)
    leaves, saved = collections.Counter(), collections.Counter()
    for node, own in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += (len(own) - 1) * (len(node[-1][1].encode()) if node else 0)
    return sorted((
        min(own), len(n), min(members[n[:-1]]) if n else None, len(own), children[n], leaves[n], saved[n],
        hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, own in members.items())


def rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def nodes_of(df):
    return sorted(tuple(r) for r in df.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect())


def conversations(spark, own, extra=()):
    rows = [(c, k, r, t, "p", 1) for c, turns in own.items() for k, (r, t) in enumerate(turns)] + list(extra)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, path string, part int").repartition(5)


def test_trie_of_odd_conversations(spark):
    rng = random.Random(3)
    words = ["", "a", "é", "long " * 50, "b"]
    own = {c: [(rng.choice(["user", "assistant"]), rng.choice(words)) for _ in range(rng.randrange(1, 12))] for c in range(0, 90) if c % 7}
    own |= {200 + c: [("user", "same"), ("assistant", "reply")] for c in range(40)}  # copies
    own |= {300 + c: own[200] + [("user", f"q{c % 3}")] for c in range(20)}
    own[500] = [("user", str(i)) for i in range(700)]  # deep, and one that leaves it late
    own[505] = own[500][:650] + [("user", "other")]
    odd = [(None, 0, "user", "lost", "p", 1), (None, None, None, None, None, None)]
    table = conversations(spark, own, odd)
    assert nodes_of(prefix_trie.prefix_trie(prefix_trie.paths(table))) == plain_trie(own)
    assert nodes_of(prefix_trie.prefix_trie(prefix_trie.regrown_paths(table))) == plain_trie(rebuilt(own))


def test_trie_of_null_turns_and_ties(spark):
    rows = [(1, None, "user", "first"), (1, 0, None, None), (1, 5, "a", "x"), (2, None, "user", "first"), (2, 0, "", ""), (2, 9, "a", "x"),
            (3, 0, "b", "y"), (3, 0, "b", "y"), (4, 0, "b", "y"), (4, 1, "b", "y")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    first, other = [("user", "first"), ("", ""), ("a", "x")], [("b", "y"), ("b", "y")]
    assert nodes_of(prefix_trie.prefix_trie(prefix_trie.paths(table))) == plain_trie({1: first, 2: first, 3: other, 4: other})
    ties = spark.createDataFrame([(c, 0, "u", t) for c, t in ((1, "x"), (1, "y"), (2, "y"), (2, "x"))], table.schema)
    found = nodes_of(prefix_trie.prefix_trie(prefix_trie.paths(ties)))
    assert [n[:4] for n in found] == [(1, 0, None, 2), (1, 1, 1, 2), (1, 2, 1, 2)]


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert nodes_of(prefix_trie.prefix_trie(prefix_trie.paths(empty))) == []
    assert nodes_of(prefix_trie.prefix_trie(prefix_trie.regrown_paths(empty))) == []
    one = spark.createDataFrame([(11, 0, "u", "x")], empty.schema)  # its family's first conversation is absent
    assert nodes_of(prefix_trie.prefix_trie(prefix_trie.regrown_paths(one))) == plain_trie(rebuilt({11: [("u", "x")]}))
    convs = spark.createDataFrame([(5, b""), (3, b"")], "conv_id long, path binary")
    assert nodes_of(prefix_trie.prefix_trie(convs)) == plain_trie({5: [], 3: []})


def terms_of(text):
    return ALNUM.findall((text or "").translate(FOLD))


def plain_search(docs, items, top):
    n = sum(bool(terms_of(t)) for _, t in docs)
    total = sum(len(terms_of(t)) for _, t in docs)
    df = collections.Counter(w for _, t in docs for w in set(terms_of(t)))
    wanted = collections.defaultdict(set)
    for i, t in items:
        wanted[i] |= set(terms_of(t))
    out = []
    for item, terms in wanted.items():
        scored = []
        for doc, text in docs:
            tf, size = collections.Counter(terms_of(text)), len(terms_of(text))
            m = 50 + (50 * size * n) // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10**9 * tf[w]) // (1000 * tf[w] + 20 * m)) for w in terms if w in tf)
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, rank, None if none else doc, -score) for rank, (score, none, doc) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("limits", [(1024, 16_384), (2, 16_384), (1024, 7)])
def test_search(spark, monkeypatch, limits):
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", limits[0])
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", limits[1])
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "A", "a", "x-y"]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 60)))) for i in range(120)]
    docs += [(500 + i, "w1 w2 w3 rare") for i in range(30)] + [(None, "rare rare"), (None, None), (7, ""), (8, "..."), (9, "rare " * 40_000)]
    items = [(1, "w1 W2 rare, w1"), (2, "w1 w2 w5 a"), (3, "w5 é nowhere"), (4, ""), (5, None), (6, "-- --"), (3, "w7"), (None, "rare")]
    table = spark.createDataFrame([(i, t, "s", 1) for i, t in docs], "doc_id long, text string, item_id string, score int").repartition(4)
    benchmark = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, rank int, doc_id string")
    found = lexical_search.search(table, benchmark, top=10)
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain_search(docs, items, 10)
    assert lexical_search.search(table.limit(0), benchmark).count() == 0
    assert lexical_search.search(table, benchmark.limit(0)).count() == 0


def test_shared_sums_add_up_to_the_items():
    rng = np.random.default_rng(1)
    terms = rng.integers(0, 1 << 62, 60).astype(np.uint64)
    items = [np.unique(rng.choice(terms[: 20 + 5 * (i % 9)], rng.integers(1, 25))) for i in range(40)]
    graph = lexical_search.share_sums(items)

    def leaves(node):
        return [node] if node < len(graph.terms) else [x for part in graph.sums[node - len(graph.terms)] for x in leaves(part)]

    for nodes, own in zip(graph.items, items):
        held = [x for n in nodes for x in leaves(n)]
        assert len(held) == len(set(held)) and np.array_equal(np.sort(graph.terms[held]), own)
    additions = sum(len(s) - 1 for s in graph.sums) + sum(len(n) - 1 for n in graph.items)
    assert additions < 0.8 * sum(len(x) - 1 for x in items)


def plain_components(docs, k, percent):
    sets = []
    for _, text in docs:
        w = BLANK.findall((text or "").translate(FOLD))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    a, b = [], []
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a.append(i), b.append(j)
    parent = {i: {i} for i in range(len(sets))}
    for i, j in zip(a, b):
        if parent[i] is not parent[j]:
            parent[i] |= parent[j]
            for x in parent[j]:
                parent[x] = parent[i]
    low = lambda i: min((docs[x][0] for x in parent[i] if docs[x][0] is not None), default=None)
    return sorted(((d, len(s), low(i) if s else d) for i, ((d, _), s) in enumerate(zip(docs, sets))), key=str)


def corpus(seed):
    """Chains of near copies whose ends are unlike, one large group around a hidden text, shared passages, copies and odd rows."""
    rng = random.Random(seed)
    word = lambda n: f"{rng.choice('abcdefgh')}{rng.randrange(n)}"
    docs, passage = [], [f"p{i}" for i in range(40)]
    for _ in range(8):
        text = [word(900) for _ in range(rng.choice([12, 60, 150, 400]))]
        for _ in range(7):
            docs.append(" ".join(text))
            text = list(text)
            for _ in range(max(1, len(text) // 60)):
                text[rng.randrange(len(text))] = word(10**6)
    hidden = [word(900) for _ in range(120)]
    for _ in range(60):
        text = list(hidden)
        for _ in range(rng.randrange(1, 4)):
            text[rng.randrange(len(text))] = word(10**6)
        docs.append(" ".join(text))
    docs += [" ".join([word(10**6) for _ in range(8)] + passage) for _ in range(40)]
    docs += [" ".join(passage), " ".join(passage).upper()] * 15 + ["one", "One", "one two", "a b c", None, "", " \n", "x" * 70_000]
    rows = list(enumerate(docs))
    rng.shuffle(rows)
    return rows + [(None, docs[0]), (None, "alone"), (3, docs[3]), (3, "other text under a used id")]


@pytest.mark.parametrize("seed, block, more", [(1, 1024, 0), (2, 16, 0), (3, 1024, 10)])
def test_jaccard_components(spark, monkeypatch, seed, block, more):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    ranks = jaccard_join.shingle_ranks
    monkeypatch.setattr(jaccard_join, "shingle_ranks", lambda *x: ranks(*x) + np.uint8(more))  # lists dealt to several tasks
    docs = corpus(seed)
    table = spark.createDataFrame([(i, t, 1, "t") for i, t in docs], "doc_id long, text string, node int, tokens string").repartition(6)
    found = sorted((tuple(r) for r in jaccard_join.jaccard_components(table).collect()), key=str)
    assert found == plain_components(docs, 3, 90)
    assert len({c for _, _, c in found}) < len(docs) - 60


def test_jaccard_of_nothing(spark):
    table = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_join.jaccard_components(table).collect() == []
    assert jaccard_join.jaccard_components(spark.createDataFrame([(1, None), (2, "")], table.schema)).where("component_id = doc_id").count() == 2


def test_parity_bits_never_exceed_the_difference():
    rng = np.random.default_rng(4)
    for n, m in ((40, 300), (300, 290), (2000, 2100), (9, 10)):
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: n // 2], rng.integers(0, 1 << 63, m - n // 2).astype(np.uint64)]))
        both, sizes = jaccard_join.parity_bits(np.concatenate([a, b]), np.array([len(a), len(b)]))
        left, right = both[:sizes[0]].tobytes(), both[sizes[0]:].tobytes()
        unlike = jaccard_join._unlike_bits([left, right, left], [right, left, left])
        assert unlike[0] == unlike[1] <= len(np.setxor1d(a, b)) and unlike[2] == 0


def test_tiles_skip_no_pair_that_may_be_linked():
    rng = np.random.default_rng(6)
    n, pos = rng.integers(9, 400, 700), rng.integers(0, 40, 700)
    i, j = np.triu_indices(700, 1)
    wanted = set(
        map(tuple, np.stack([i, j], axis=1)[jaccard_join._may_link(pos, n, i, j, 90)].tolist()))
    seen = {tuple(sorted(p)) for a, b in jaccard_join._tiles(pos, n, 90) for p in zip(a.tolist(), b.tolist())}
    assert wanted <= seen and len(seen) < len(i)


def test_groups_are_whole_across_batches():
    keys = np.repeat(np.arange(50), np.random.default_rng(2).integers(1, 9, 50))
    table = pa.table({"k": keys, "v": np.arange(len(keys))})
    parts = list(jaccard_join._groups(iter(table.to_batches(max_chunksize=3)), "k"))
    assert np.concatenate([t["v"].to_numpy() for t, _ in parts]).tolist() == list(range(len(keys)))
    assert sum(len(s) - 1 for _, s in parts) == 50 and all(s[-1] == t.num_rows for t, s in parts)


def test_forest_joins_every_part_once():
    a, b = np.array([1, 2, 1, 5, 6]), np.array([2, 3, 3, 6, 5])
    assert forest(a, b) == [0, 1, 3]


def test_new_queries_equal_their_sql(spark):
    from compare import connect, difference
    from invoice_lake.llm.oracle import STATEMENTS
    from invoice_lake.llm.queries import REGISTRY

    for name in ("op11_peeled_trie", "op12_shared_search", "op13_skipping_jaccard"):
        assert difference(REGISTRY[name](spark, SF_DIR), connect(SF_DIR).sql(STATEMENTS[name])) is None

