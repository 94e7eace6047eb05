"""The text operators against brute force, on odd rows and on the small tables."""

import collections
import functools
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from compare import connect, difference
from invoice_lake.llm import (
    chat, decontamination, language_id, learning, minhash_dedup, packing, quality_classifier, quality_rules, queries, sharding, token_counts,
    token_files, tokens,
)
from invoice_lake.llm.components import connected_components
from invoice_lake.llm.learning import held_out
from invoice_lake.llm.oracle import STATEMENTS
from invoice_lake.llm.storage import scratch_path
from invoice_lake.llm.words import ALNUM_WORDS, BLANK_WORDS, KEEP_CASE, LOWER, texts_of
from tests.conftest import SF_DIR

WORD, BYTE = queries.WORD_TOKENIZER, queries.BYTE_TOKENIZER
BLANK = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
LONG = " ".join(f"w{i * 7919 % 4001}" for i in range(30_000))
TEXTS = [
    None, "", " \n\t", "one", "Two words", "a b c d e", "A B C D E", "###", "…", "été Ça", "don't stop'", "x  y   z \n\n q\r\n",
    "no break　wide", "say <|endoftext|> now", "tail ", " head", "a" * 70_000, LONG, LONG, LONG + " end", "12 3.5e-7", "\x00\x1f",
    "é İ ` ẞ ŉ ﬁ", "same line\nsame line\nother\nsame line",
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeats, and columns whose names clash with those of the results."""
    rows = [(i, t, "en" if i % 2 else None, "s", i, i, "b") for i, t in enumerate(TEXTS)]
    rows += [(None, "no id here", None, None, None, 1, "b"), (3, "one", "en", "s", 1, 1, "b")]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_words long, shard int, record string").repartition(3).cache()


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF_DIR}/labels.parquet")


@functools.lru_cache
def library(path):
    return Tokenizer.from_file(path)


def library_ids(path, text):
    return library(path).encode(text or "", add_special_tokens=False).ids


def test_words_equal_the_patterns():
    texts = texts_of(pa.array(TEXTS))
    for members, pattern in ((BLANK_WORDS, BLANK), (ALNUM_WORDS, ALNUM)):
        hashes, first = texts.words(members, LOWER)
        words = [w for t in TEXTS for w in pattern.findall((t or "").translate(FOLD))]
        assert np.diff(first).tolist() == [len(pattern.findall((t or "").translate(FOLD))) for t in TEXTS]
        meaning = dict(zip(hashes.tolist(), words))
        assert [meaning[h] for h in hashes.tolist()] == words and len(meaning) == len(set(words))


def test_token_ids_equal_the_library():
    texts = texts_of(pa.array(TEXTS))
    word, byte = Tokenizer.from_file(WORD), Tokenizer.from_file(BYTE)
    flat, begins = tokens.word_ids(WORD).ids(texts)
    counts = tokens.byte_ids(BYTE).counts(texts)
    for i, text in enumerate(TEXTS):
        assert flat[begins[i]:begins[i + 1]].tolist() == word.encode(text or "", add_special_tokens=False).ids
        assert counts[i] == len(byte.encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("bound", [1, 7, 4500])
def test_texts_with_more_distinct_pieces_than_the_cache(monkeypatch, bound):
    monkeypatch.setattr(tokens, "CACHE_PIECES", bound)
    many = [" ".join(f"{i * 7919} k{i % 50}" for i in range(6000 if bound > 100 else 60)), "", "tail of k1 words", "<|odd|> k2"]
    texts = texts_of(pa.array(many + many))
    word, byte = tokens.PieceIds(WORD, tokens.cut_dropping_blanks, LOWER, tokens._lower_letters), tokens.PieceIds(
        BYTE, tokens.cut_keeping_blanks, KEEP_CASE, tokens._spaced_letters)
    for _ in range(2):
        flat, begins = word.ids(texts)
        assert [flat[a:b].tolist() for a, b in zip(begins, begins[1:])] == [library_ids(WORD, t) for t in many + many]
        assert byte.counts(texts).tolist() == [len(library_ids(BYTE, t)) for t in many + many]
        assert len(word.known) <= bound and len(byte.known) <= bound


@pytest.mark.parametrize("text", [LONG[:9000], "ab " * 900 + "x" * 5000 + " cd" * 900, "y" * 9000, "a  b" * 2000, "é\n" * 3000, "<|endoftext|> q" * 500])
def test_spliced_chunks_count_like_the_whole(text):
    encoder = Tokenizer.from_file(BYTE)
    assert token_counts.count_huge(encoder, text, chunk=700, overlap=40) == len(encoder.encode(text, add_special_tokens=False).ids)


def test_token_counts(odd):
    rows = token_counts.count_tokens(odd, BYTE).select("text", "n_bytes", "n_tokens", "over_limit", "record").collect()
    assert len(rows) == odd.count()
    for r in rows:
        n = len(library_ids(BYTE, r.text))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((r.text or "").encode()), n, n > 512)


@pytest.mark.parametrize("block", [minhash_dedup.BLOCK, 3])
def test_near_duplicates(odd, documents, block, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "BLOCK", block)
    docs = odd.select("doc_id", "text", "n_words").unionByName(
        documents.select((F.col("doc_id") + 1000).alias("doc_id"), "text", F.lit(1).cast("long").alias("n_words")))
    out = {r.doc_id: r for r in minhash_dedup.near_duplicates(docs).collect()}
    sets = {}
    for r in docs.where("doc_id is not null").collect():
        w = BLANK.findall((r.text or "").translate(FOLD))
        sets[r.doc_id] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    for k, v in sets.items():
        assert (out[k].n_shingles, out[k].component_id, out[k].kept) == (len(v), root(k), root(k) == k)
    assert out[None].component_id is None and out[None].kept
    kept = minhash_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {k for k in out if out[k].kept}


def test_blocks_of_one_component_do_not_meet(spark, monkeypatch):
    """A bucket of one large, one middle and many small components, and buckets of one component or of large ones only."""
    monkeypatch.setattr(minhash_dedup, "BLOCK", 10)
    sizes = {1: {1: 95, 1000: 6, **{2000 + i: 1 + i % 3 for i in range(20)}}, 2: {1: 40}, 3: {1: 12, 500: 17}, 4: {1: 1, 2: 1}}
    rows = [(band, low + i, low, 7) for band, parts in sizes.items() for low, n in parts.items() for i in range(n)]
    labelled = spark.createDataFrame(rows, "band long, doc_id long, component long, n_shingles long").withColumn("marks", F.lit(b""))
    placed = minhash_dedup._in_blocks(labelled).collect()
    assert sorted((r.band, r.doc_id) for r in placed) == sorted((b, d) for b, d, *_ in rows if b != 2)
    for band in (1, 3, 4):
        inside = [r for r in placed if r.band == band]
        others = lambda r: {o for o in range(r.blocks) if r.first is None or not r.first <= o < r.first + r.own}
        for r in inside:
            assert 0 <= r.block < r.blocks
            for x in inside:
                if x.component != r.component:
                    assert x.block in others(r) and r.block in others(x)
                elif r.first is not None:
                    assert x.block not in others(r)
        rows_met = sum(len(others(r)) for r in inside)
        assert rows_met <= len(inside) * (1 + len(sizes[band]))
    assert {r.blocks for r in placed if r.band == 3} == {2 + 2} and {r.blocks for r in placed if r.band == 4} == {1}


def test_blocks_confirm_all_links():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 60, 200)
    sets = [np.unique(np.concatenate([base[:200 - k], rng.integers(0, 1 << 60, k)])) for k in range(0, 40, 2)]
    marks = []
    for s in sets:
        low = minhash_dedup.minima(s.astype(np.uint64), np.array([0]), 192)
        marks.append(((low * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes())
    n = len(sets)
    group = pa.table({
        "doc_id": pa.array(range(n), pa.int64()), "component": pa.array(range(n), pa.int64()), "n_shingles": pa.array([len(s) for s in sets]),
        "marks": pa.array(marks, pa.binary()), "shingles": pa.array([s.tolist() for s in sets], pa.list_(pa.int64())),
        "block": pa.array([0] * n), "lo": pa.array([0] * n), "hi": pa.array([0] * n)})
    links = minhash_dedup._compare(group, 192, 85).to_pydict()
    true = {(a, b) for a in range(n) for b in range(a) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b]))}
    found = {(b, a) for a, b in zip(links["a"], links["b"])}
    assert found <= true and len(found) < n

    def parts(pairs):
        part = list(range(n))
        for a, b in pairs:
            part = [part[b] if p == part[a] else p for p in part]
        return collections.Counter(tuple(i for i in range(n) if part[i] == p) for p in set(part))

    assert parts(found) == parts(true)


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 200), (300, 200), (5, 5), (None, 3)] + [(1000, 1000 + i) for i in range(1, 50)]
    out = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert out == {**{i: 1 for i in range(1, 61)}, 100: 100, 200: 100, 300: 100, **{1000 + i: 1000 for i in range(50)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_contamination(spark, odd):
    items = [(1, "a b c d e"), (2, " ".join(LONG.split()[100:125])), (3, "Two"), (10, None), (11, "--"), (12, "two words"), (13, "TWO  words")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    windows = collections.defaultdict(set)
    for item, text in items:
        w = ALNUM.findall((text or "").translate(FOLD))
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i:i + n])].add(str(item))
    expected = collections.Counter()
    for r in odd.collect():
        w, hit, found = ALNUM.findall((r.text or "").translate(FOLD)), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        expected[(r.doc_id, len(w), len(hit), tuple(sorted(found)))] += 1
    rows = decontamination.contamination(odd, benchmark).collect()
    assert collections.Counter((r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids)) for r in rows) == expected
    assert all(r.n_hit == sum(s.end - s.begin for s in r.spans) for r in rows)
    clean = decontamination.drop_contaminated(odd, benchmark)
    assert clean.columns == odd.columns and 0 < clean.count() < odd.count()
    assert decontamination.contamination(odd, benchmark.limit(0)).where("n_hit > 0").count() == 0


def test_windows_share_fingerprints():
    text = texts_of(pa.array([" ".join(f"q{i % 13}" for i in range(60)), "x y " + " ".join(f"q{i % 13}" for i in range(7, 40))]))
    words, first = text.words(ALNUM_WORDS, LOWER)
    prints, _, begins, hashes = decontamination.fingerprints(words, first)
    meaning = {}
    for p, h in zip(prints.tolist(), hashes.tolist()):
        assert meaning.setdefault(h, p) == p


def _hits_by_brute_force(docs, items):
    """(n_words, n_hit, items) of each text by comparing all windows of words."""
    windows = collections.defaultdict(set)
    for item, text in items:
        w = text.split()
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i:i + n])].add(str(item))
    for doc, text in docs:
        w, hit, found = text.split(), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        yield doc, len(w), len(hit), tuple(sorted(found))


@pytest.mark.parametrize("seed, vocabulary", [(1, 2), (2, 3), (3, 40)])
def test_every_shared_window_is_found(spark, seed, vocabulary):
    """Few words make ties among gram hashes; shared spans have nine to thirteen words, at any place of both texts."""
    rng = np.random.default_rng(seed)
    def words(n):
        return [f"t{i}" for i in rng.integers(0, vocabulary, n)]
    items = [(i, words(n)) for i, n in enumerate([0, 9, 10, 10, 11, 14, 30, 60, 60])]
    docs = []
    for i in range(60):
        _, item = items[rng.integers(1, len(items))]
        size = int(rng.integers(9, 14))
        at = int(rng.integers(0, max(1, len(item) - size + 1)))
        docs.append((i, words(rng.integers(0, 12)) + item[at:at + size] + words(rng.integers(0, 12))))
    items += [(90, items[7][1]), (91, items[7][1][:40])]
    docs, items = ([(i, " ".join(w)) for i, w in rows] for rows in (docs, items))
    out = decontamination.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids)) for r in out.collect()) == list(_hits_by_brute_force(docs, items))


def test_kept_grams_are_thinned():
    words, first = texts_of(pa.array([LONG, None, "a b c"])).words(ALNUM_WORDS, LOWER)
    prints, places = decontamination.kept_grams(words, first, 10)
    assert len(places) == len(set(places.tolist())) < 0.5 * len(words)
    assert np.diff(places).max() <= 10 - decontamination.GRAM + 1


def test_quality_rules(odd, documents, labels):
    model = quality_rules.fit_quality(documents, labels)
    out = quality_rules.judge(odd, model)
    assert set(odd.columns) - {"n_words"} < set(out.columns)
    for r in out.collect():
        text = r.text or ""
        w = BLANK.findall(text)
        lines = [x for x in text.split("\n") if BLANK.search(x)]
        seen = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        covered = {i + j for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for j in range(3)}
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and not (r.base_failed and r.quality_kept)
        assert 0 <= r.quality_probability <= 1
    empty = quality_rules.fit_quality(documents.limit(0), labels)
    assert quality_rules.judge(odd.limit(0), empty).count() == 0


def test_classifiers_on_the_held_out_fold(spark):
    folder = SF_DIR.replace("0.001", "0.01")
    truth = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, score in (("op1_quality_neighbours", F.col("predicted")), ("op9_ngram_quality_rules", (F.col("probability") >= 0.3).cast("int"))):
        out = queries.REGISTRY[name](spark, folder)
        rows = out.join(truth, "doc_id").where(held_out()).select("quality", score.alias("p")).collect()
        assert np.mean([r.quality == r.p for r in rows]) > 0.95 and all(r.p == 1 for r in rows if r.quality == 1)
    out = language_id.identify(docs, language_id.fit_languages(docs.where(~held_out()))).where(held_out()).collect()
    assert np.mean([r.lang == r.lang_pred for r in out]) > 0.98 and np.mean([r.lang_rejected for r in out]) < 0.01


FOREIGN = [
    "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto",
    "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem i sumieniem",
    "bütün insanlar hür haysiyet ve haklar bakımından eşit doğarlar akıl ve vicdana sahiptirler",
    "все люди рождаются свободными и равными в своем достоинстве и правах",
    " ".join(hashlib.sha256(bytes([i])).hexdigest() for i in range(30)),
    " ".join("".join(chr(97 + b % 26) for b in hashlib.sha256(bytes([i])).digest()[:4 + i % 6]) for i in range(200)),
]


def test_foreign_texts_and_noise_are_rejected(spark):
    docs = spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/documents.parquet")
    model = language_id.fit_languages(docs.where(~held_out()))
    odd = spark.createDataFrame(list(enumerate(FOREIGN)), "doc_id long, text string")
    assert [r.lang_rejected for r in language_id.identify(odd, model).collect()] == [True] * len(FOREIGN)
    again = language_id.fit_languages(docs.where(~held_out()).orderBy(F.rand(5)).repartition(7))
    assert again.languages == model.languages and np.array_equal(again.centroids, model.centroids)


def test_clusters_are_no_single_odd_rows():
    rng = np.random.default_rng(4)
    bulk = np.repeat(np.eye(3, 20), [200, 150, 100], axis=0) + rng.normal(0, 0.05, (450, 20))
    rows = np.vstack([bulk, np.eye(20)[[10, 11, 12]]]).astype(np.float32)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    centroids = language_id._cluster(rows, 6)
    members = np.bincount(np.argmax(rows @ centroids.T, axis=1), minlength=len(centroids))
    assert members.min() >= language_id.LEAST_SHARE * len(rows) and len(centroids) > 1
    assert len(language_id._cluster(rows[:1], 4)) == len(language_id._cluster(np.repeat(rows[:1], 9, axis=0), 4)) == 1


def test_nearest_centroid_equals_a_plain_comparison(documents):
    model = language_id.fit_languages(documents.where(~held_out()))
    texts = [r.text for r in documents.where("text is not null").orderBy("doc_id").limit(40).collect()]
    found = language_id.identify(documents.select("doc_id", "text"), model).where("text is not null").orderBy("doc_id").limit(40).collect()
    for text, row in zip(texts, found):
        counts = language_id.letter_grams(texts_of(pa.array([text])), language_id.WIDTH)
        vector = language_id.damp(counts, model.weights)[0].astype(float)
        cosines = [(sum(a * b for a, b in zip(vector, c.astype(float)) if a), lang) for c, lang in zip(model.centroids, model.languages)]
        best = max(cosines)
        if not any(c.isalpha() for c in text):
            assert (row.lang_pred, row.lang_score) == ("und", 0)
            continue
        assert row.lang_score == pytest.approx(min(1, max(0, best[0])), abs=1e-4)
        assert row.lang_pred in {lang for c, lang in cosines if c > best[0] - 1e-4}


def test_classifiers_on_odd_rows(odd, documents, labels):
    model = language_id.fit_languages(documents)
    rows = language_id.identify(odd, model).collect()
    assert len(rows) == odd.count()
    for r in rows:
        lettered = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred in model.languages) == lettered and 0 <= r.lang_score <= 1 and (lettered or r.lang_rejected)
    nothing = language_id.fit_languages(documents.limit(0))
    assert {r.lang_pred for r in language_id.identify(odd, nothing).collect()} == {"und"}
    voted = quality_classifier.fit_neighbours(documents, labels)
    rows = quality_classifier.score_quality(odd, voted).collect()
    assert all(0 <= r.quality_score <= 1 and r.quality_predicted == (r.quality_score >= 0.3) for r in rows)
    blank = quality_classifier.fit_neighbours(documents, labels.limit(0))
    assert {r.quality_score for r in quality_classifier.score_quality(odd, blank).collect()} == {0.5}


def test_neighbours_equal_a_plain_vote(documents, labels):
    model = quality_classifier.fit_neighbours(documents, labels)
    texts = texts_of(pa.array([r.text for r in documents.limit(40).collect()]))
    counts = quality_classifier.word_and_byte_grams(texts, quality_classifier.WIDTH)
    latent = quality_classifier._unit(quality_classifier.damp_halves(counts, model.weights) @ model.axes)
    for score, row in zip(model.scores(counts), latent @ model.vectors.T):
        near = np.argsort(-row)[:quality_classifier.NEIGHBOURS]
        share = np.where(model.labels[near] == 1, model.prior, 1 - model.prior)
        weight = np.maximum(row[near], 0).astype(float) ** 8 / share
        assert score == pytest.approx((weight * model.labels[near]).sum() / weight.sum(), abs=1e-4)


def check_pieces(pieces, docs, path):
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in pieces:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for r in docs:
        ids = np.array(library_ids(path, r.text) + [2], "<u4")
        end = 0
        for p in sorted(by_doc[r.doc_id], key=lambda p: p.start):
            assert p.start == end and p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[end:end + p.length].tobytes())
            end += p.length
        assert end == len(ids)
    for parts in by_sequence.values():
        end = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == end
            end += p.length
        assert end <= 4096
    return sum(r.length for r in pieces) / (4096 * len(by_sequence))


def test_packing(odd, documents):
    unique = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    check_pieces(packing.pack(unique, WORD).collect(), unique.collect(), WORD)
    assert packing.pack(odd, WORD).agg(F.sum("length")).first()[0] > 0
    full = check_pieces(packing.pack(documents, WORD).collect(), documents.collect(), WORD)
    assert full > 0.97
    assert packing.pack(odd.limit(0), WORD).count() == 0


@pytest.mark.parametrize("capacity", [5000, 2048, 100])
def test_packing_with_another_capacity(spark, capacity):
    docs = {1: LONG, 2: "one two", 3: LONG[:3000], 4: None}
    rows = packing.pack(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), WORD, capacity=capacity).collect()
    for doc_id, text in docs.items():
        ids, end = np.array(library_ids(WORD, text) + [2], "<u4"), 0
        for p in sorted((r for r in rows if r.doc_id == doc_id), key=lambda r: r.start):
            assert p.start == end and p.ids_crc32 == zlib.crc32(ids[end:end + p.length].tobytes())
            end += p.length
        assert end == len(ids)
    ends = collections.defaultdict(int)
    for p in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert p.offset == ends[p.sequence_id]
        ends[p.sequence_id] += p.length
    assert max(ends.values()) <= capacity


def test_differencing_is_nearly_even():
    sizes = np.random.default_rng(5).integers(1, 512, 900)
    window = packing.difference(sizes, 40)
    sums = np.bincount(window, weights=sizes, minlength=40)
    assert sums.max() - sums.min() < 60
    assert np.bincount(packing.balance(sizes, 4096), weights=sizes).max() <= 4096
    assert packing.balance(np.array([4096, 4096, 1])).tolist() in ([0, 1, 2], [1, 0, 2])
    assert packing.cuts(4096) == [(0, 4096)] and packing.cuts(1) == [(0, 1)]


def test_token_files(spark, odd, documents):
    for docs in (odd, documents):
        folder = scratch_path(spark, "test-tokens")
        index = token_files.write_token_files(docs, folder, WORD)
        out = collections.Counter(map(tuple, token_files.read_token_files(index).collect()))
        rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
        start, expected = 0, collections.Counter()
        for r in rows:
            ids = np.array(library_ids(WORD, r.text) + [2], "<u4")
            expected[(r.doc_id, start, len(ids), zlib.crc32(ids.tobytes()))] += 1
            start += len(ids)
        assert out == expected
    first = index.orderBy("part", "number", "place").first()
    ids, mask = token_files.sequence(first.file, 0)
    assert len(ids) == token_files.LENGTH == 8 * len(mask) and not ids.flags.owndata
    nothing = token_files.write_token_files(odd.limit(0), scratch_path(spark, "test-tokens"), WORD)
    assert token_files.read_token_files(nothing).count() == 0


def test_masks_are_read_without_a_copy(spark):
    docs = spark.createDataFrame([(1, LONG), (2, "two words")], "doc_id long, text string").coalesce(1)
    index = token_files.write_token_files(docs, scratch_path(spark, "test-tokens"), WORD)
    for file, total in index.groupBy("file").agg(F.sum("n_tokens")).collect():
        for number in range(-(-total // token_files.LENGTH)):
            ids, mask = token_files.sequence(file, number)
            assert not ids.flags.owndata and not mask.flags.owndata
            assert token_files.flags(mask).tolist() == [number * token_files.LENGTH + i < total for i in range(token_files.LENGTH)]


def test_equal_ids_are_split_over_files_in_order(spark):
    docs = spark.createDataFrame([(5, f"text number {i}") for i in range(400)], "doc_id long, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    index = token_files.write_token_files(docs, scratch_path(spark, "test-tokens"), WORD)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert index.select("file").distinct().count() == 4
    out = sorted((r.start, r.n_tokens) for r in token_files.read_token_files(index).collect())
    assert len(out) == 400 and all(a + n == b for (a, n), (b, _) in zip(out, out[1:]))


def test_one_labelled_id_on_many_rows_keeps_the_bound(spark):
    docs = spark.createDataFrame([(1, f"copy {i}") for i in range(5000)] + [(i, "x") for i in range(2, 200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 200)], "doc_id long, quality int")
    found = learning.labelled_texts(docs, labels, "quality", 10**6).collect()
    assert len(found) == len({r.doc_id for r in found}) > 100
    assert 0 < learning.labelled_texts(docs, labels, "quality", 20).count() < 60
    many = spark.range(10**6).select(F.col("id").alias("doc_id"))
    assert 0 < learning.sample_below(many, "doc_id", 5).count() < 30


def test_repeated_near_copies_are_confirmed_once(spark):
    words = [f"w{i}" for i in range(60)]
    a, b = " ".join(words), " ".join(words + ["end"])
    docs = spark.createDataFrame([(1, a), (2, b)] * 1000, "doc_id long, text string").repartition(4)
    sizes = {}
    settle = minhash_dedup.settle

    def counted(df, name):
        out = settle(df, name)
        sizes.setdefault(name, out.count())
        return out

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(minhash_dedup, "settle", counted)
        found = minhash_dedup.near_duplicates(docs).select("component_id").distinct().collect()
    assert [r.component_id for r in found] == [1] and sizes["sets"] == 2 and sizes["links"] == 1


def test_struct_fields_of_any_name(spark, documents, labels):
    docs = documents.limit(50).select("doc_id", "text", "lang", F.col("n_chars").alias("n-chars"), F.struct(F.col("doc_id").alias("a b"), F.col("source").alias("c-d")).alias("odd x"))
    for out in (
        token_counts.count_tokens(docs, BYTE), sharding.write_shards(docs, scratch_path(spark, "test-shards")),
        quality_classifier.score_quality(docs, quality_classifier.fit_neighbours(documents, labels)),
        quality_rules.judge(docs, quality_rules.fit_quality(documents, labels)), language_id.identify(docs, language_id.fit_languages(documents)),
    ):
        assert out.count() == 50


def test_sharding(spark, odd, documents):
    for docs, size in ((odd, 1 << 20), (documents, 40_000)):
        written = [sharding.write_shards(docs, scratch_path(spark, "test-shards"), bucket_bytes=size) for _ in range(2)]
        rows = [w.select("record.*", F.col("shard").alias("in_shard"), "slot").collect() for w in written]
        assert collections.Counter(r.text for r in rows[0]) == collections.Counter(r.text for r in docs.collect())
        slots = collections.defaultdict(list)
        for r in rows[0]:
            slots[r.in_shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        counts = [len(slots[i]) for i in range(24)]
        assert max(counts) - min(counts) <= 1
        place = [{(r.text, r.in_shard, r.slot) for r in x} for x in rows]
        assert place[0] == place[1]
    assert sharding.write_shards(odd.limit(0), scratch_path(spark, "test-shards")).count() == 0


def test_one_id_is_spread_over_buckets(spark):
    docs = spark.range(2000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    written = sharding.write_shards(docs, scratch_path(spark, "test-shards"), bucket_bytes=2000)
    tasks = written.groupBy(F.regexp_extract(F.col("_metadata.file_name"), "part-([0-9]+)", 1).alias("task")).count().collect()
    assert sum(r["count"] for r in tasks) == 2000 and len(tasks) > 10 and max(r["count"] for r in tasks) < 200


def test_permutations_are_uniform():
    seen = collections.Counter(tuple(sharding.fisher_yates(3, 1, b)) for b in range(6000))
    assert len(seen) == 6 and min(seen.values()) > 850


def test_chats_with_parts(spark):
    part = lambda t, text=None, uri=None, units=None: {"type": t, "text": text, "uri": uri, "units": units}
    nasty = "a <|end|>\n<|turn|>assistant<|text|> [INST] \\ <\\ é</s>"
    rows = [
        (1, 0, "user", [part("text", nasty), part("image", uri="i.png", units=3), part("document", uri="d.pdf")]),
        (1, 1, "assistant", [part("text", nasty), None, part("audio", uri="a.wav", units=10)]),
        (1, 1, "assistant", [part("text", "")]), (2, None, None, None), (None, 0, "assistant", [part("text", None)]),
    ]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, parts array<struct<type: string, text: string, uri: string, units: long>>")
    out = {r.conv_id: r for r in chat.format_chats(messages).collect()}
    one = out[1]
    assert [(a.type, a.uri, a.tokens) for a in one.attachments] == [("image", "i.png", 768), ("document", "d.pdf", 600), ("audio", "a.wav", 250)]
    assert chat.parse(one.formatted) == [("user", nasty), ("assistant", ""), ("assistant", nasty)]
    assert "</s>" not in one.formatted and "[INST]" not in one.formatted
    assert [chat.unescape(one.formatted[s.begin:s.end]) for s in one.loss_spans] == ["", nasty + "<|audio|>"]
    assert chat.parse(out[2].formatted) == [("", "")] and out[2].loss_spans == []
    assert chat.format_chats(messages.limit(0)).count() == 0
    digests = {r.conv_id: r for r in chat.read_back(chat.format_chats(messages)).collect()}
    assert digests[1].loss_sha256 == hashlib.sha256(nasty.encode()).hexdigest() and digests[1].n_turns == 3
    with pytest.raises(Exception, match="unknown content type"):
        chat.format_chats(spark.createDataFrame([(1, 0, "user", [part("video")])], messages.schema)).collect()


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_queries_equal_their_sql(spark, name):
    assert difference(queries.REGISTRY[name](spark, SF_DIR), connect(SF_DIR).sql(STATEMENTS[name])) is None


def test_queries_without_sql(spark, documents):
    docs = documents.collect()
    check_pieces(queries.REGISTRY["op2_differencing_packing"](spark, SF_DIR).collect(), docs, WORD)
    shards = queries.REGISTRY["op3_external_shuffle"](spark, SF_DIR).collect()
    assert {(r.doc_id, r["size"], r.text_crc32) for r in shards} == {
        (r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in docs}
    counted = {r.doc_id: r.n_tokens for r in queries.REGISTRY["op5_resynchronised_token_counts"](spark, SF_DIR).collect()}
    assert counted == {r.doc_id: len(library_ids(BYTE, r.text)) for r in docs}
    assert queries.REGISTRY["op7_arrow_token_files"](spark, SF_DIR).count() == len(docs)


def test_tokenizers_are_the_given_files():
    assert WORD == public_tokenizers.path("word_bpe_49k.json") and BYTE == public_tokenizers.path("byte_bpe_50k.json")
