"""Ranked search and the PartEnum join on awkward inputs, against brute force."""

import math
import random
import re

import numpy as np
import pytest

from kedai.llm import jaccard, ranking

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


# --- ranked search --------------------------------------------------------------------------


def brute_rank(docs, items, top=50):
    texts = [(d, re.findall(TERM, (t or "").translate(LOWER))) for d, t in docs]
    texts = [(d, t) for d, t in texts if t]
    n_docs, n_terms = len(texts), sum(len(t) for _, t in texts)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(re.findall(TERM, (text or "").translate(LOWER)))
    out = []
    for item, terms in wanted.items():
        found = []
        for doc, text in texts:
            m = 50 + (50 * len(text) * n_docs) // n_terms
            score = 0
            for term in terms & set(text):
                df, tf = sum(term in t for _, t in texts), text.count(term)
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                score += w * ((1000000000 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                found.append((-score, doc is None, doc))
        found.sort(key=lambda row: (row[0], row[1], row[2] or 0))
        out += [(item, k + 1, doc, -score) for k, (score, _, doc) in enumerate(found[:top])]
    return out


ITEMS = [
    (1, "The quick brown FOX"), (2, None), (3, ""), (4, "étè ß 𝔘 mail"), (4, "license"), (None, "two word"),
    (5, "the the of"), (6, "w1x1 w4x2 w9x3"), (7, "no such thing anywhere"),
]


def ranked(docs, items, **options):
    rows = ranking.rank(docs, items, **options).select("item_id", "rank", "doc_id", "score").collect()
    return sorted(map(tuple, rows), key=repr)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(i, t, "x", 1) for i, t in ITEMS]
    return spark.createDataFrame(rows, "item_id long, text string, doc_id string, rank int")


def test_ranks_of_odd_texts(odd, items):
    docs = [(row.doc_id, row.text) for row in odd.collect()]
    assert ranked(odd, items) == sorted(brute_rank(docs, ITEMS), key=repr)
    assert ranked(odd, items, top=2) == sorted(brute_rank(docs, ITEMS, 2), key=repr)


def test_ranks_over_windows_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(ranking, "WINDOW", 16)
    monkeypatch.setattr(ranking, "BLOCK_BYTES", 64)
    rng = random.Random(5)
    words = [f"t{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 60)))) for i in range(300)]
    wanted = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 12)))) for i in range(12)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    queries = spark.createDataFrame(wanted, "item_id int, text string")
    blocks = list(ranking.blocks(queries, "item_id", "text", 64))
    assert len(blocks) > 1 and sum(len(block.ids) for block in blocks) == 12
    monkeypatch.setattr(ranking.blocks, "__defaults__", (64,))
    assert ranked(table, queries, top=7) == sorted(brute_rank(docs, wanted, 7), key=repr)


def test_ranking_of_empty_tables(spark, odd, none, items):
    assert ranked(none, items) == []
    assert ranked(odd, items.limit(0)) == []
    assert ranking.rank(odd, items.limit(0)).columns == ranking.rank(odd, items).columns


def test_search_skips_and_loses_nothing():
    """Whatever the least score, exactly the documents that reach it come back, with whole scores."""
    rng = np.random.default_rng(2)
    for _ in range(40):
        n_docs, n_terms = 64, 9
        held = rng.random((n_terms, n_docs)) < rng.uniform(0.01, 0.9, (n_terms, 1))
        parts = rng.integers(1, 1000, (n_terms, n_docs)) * held
        terms, places = np.nonzero(held)
        lists = ranking.Lists(terms, places, parts[terms, places].astype(np.int64), n_terms, n_docs)
        wanted = rng.choice(n_terms, 5, replace=False).tolist()
        scores = parts[wanted].sum(axis=0)
        for least in (1, 300, 900, int(scores.max()), int(scores.max()) + 1):
            found, values = lists.search(wanted, least)
            assert dict(zip(found.tolist(), values.tolist(), strict=True)) == {
                k: int(s) for k, s in enumerate(scores) if s >= least
            }


# --- n-gram Jaccard join --------------------------------------------------------------------


def brute_groups(docs, size, percent):
    sets = []
    for _, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        k = min(size, len(words))
        sets.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set())
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(docs)):
        for y in range(x):
            both = len(sets[x] & sets[y])
            if both and None not in (docs[x][0], docs[y][0]) and 100 * both >= percent * len(sets[x] | sets[y]):
                root[find(x)] = find(y)
    least = {}
    for x, (doc, _) in enumerate(docs):
        if doc is not None:
            least[find(x)] = min(doc, least.get(find(x), doc))
    return sorted(
        ((doc, len(sets[x]), None if doc is None else least[find(x)]) for x, (doc, _) in enumerate(docs)), key=repr
    )


def grouped(df, size, percent):
    return sorted(map(tuple, jaccard.join_groups(df, size, percent).collect()), key=repr)


def test_groups_of_odd_texts(odd, none):
    docs = [(row.doc_id, row.text) for row in odd.collect()]
    for size, percent in ((3, 90), (5, 80)):
        assert grouped(odd, size, percent) == brute_groups(docs, size, percent)
    assert grouped(none, 3, 90) == []


def varied(rng, base, changes):
    words = list(base)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"v{rng.randrange(10**6)}"
    return " ".join(words)


def test_one_large_group_of_near_copies(spark, monkeypatch):
    """Copies of one text around the threshold share keys in many ways; a common passage joins none."""
    monkeypatch.setattr(jaccard, "GROUP", 7)
    monkeypatch.setattr(jaccard, "HUBS", 1)
    rng = random.Random(8)
    base = [f"b{k}" for k in range(90)]
    texts = [varied(rng, base, rng.choice([0, 1, 1, 2, 3, 4])) for _ in range(120)]
    texts += [varied(rng, base[:70], 0) + " " + " ".join(f"o{i}x{k}" for k in range(i % 30)) for i in range(60)]
    texts += [texts[0]] * 5 + ["short text here", "short text here too"] * 3
    docs = [(7 * i % 1009, text) for i, text in enumerate(texts)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert grouped(table, 3, 90) == brute_groups(docs, 3, 90)


@pytest.mark.parametrize("percent", [80, 90])
def test_similar_sets_share_a_signature(percent):
    """No similar pair is without a common key, at sizes from one element to thousands."""
    rng = np.random.default_rng(4)
    for size in [*range(1, 60), 100, 333, 1000, 4000]:
        for _ in range(6):
            x = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
            gone = rng.integers(0, size * (100 - percent) // 100 + 1)
            new = rng.integers(0, 1 << 63, rng.integers(0, gone + 2)).astype(np.uint64)
            y = np.unique(np.concatenate([rng.permutation(x)[gone:], new]))
            both = len(np.intersect1d(x, y))
            if not both or 100 * both < percent * (len(x) + len(y) - both) or jaccard.class_of(x) == jaccard.class_of(y):
                continue
            assert np.intersect1d(jaccard.signatures(x, percent), jaccard.signatures(y, percent)).size
            u, v = (np.array(jaccard.sketch(s)).view(np.uint64) for s in (x, y))
            assert np.bitwise_count(u ^ v).sum() <= len(x) + len(y) - 2 * both
