"""Awkward inputs and forced paths of every operator, against brute force."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from compare import oracle_rows, spark_rows
from pyspark.sql import functions as F
from test_queries import base_spans, check_packing, near_pairs

from kedai.llm import (
    ann,
    chat,
    components,
    decontaminate,
    licenses,
    neardup,
    packing,
    pii,
    planes,
    quality,
    queries,
    substring,
)


@pytest.fixture(scope="module")
def table(odd):
    return odd.toPandas()


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1), (2, 1), (10, 1), (12, 0), (None, 1), (4, None), (11, 1), (11, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int")


@pytest.fixture(scope="module")
def encoder(tokenizer):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer)
    return lambda text: plain.encode(text or "", add_special_tokens=False).ids + [0]


# --- nearest neighbours ---------------------------------------------------------------------


def test_nearest_with_bad_ties_and_repeated_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 3), 1.0], 0) for i in range(30)]
    rows += [(30, None, 0), (31, [0.0, 0.0], 0), (32, [nan, 1.0], 0), (33, [inf, 1.0], 0), (40, [1.0], 0)]
    rows += [(34, [None, 1.0], 0), (None, [1.0, 1.0], 0), (20, [2.0, 1.0], 0), (5, [2.0, 1.0], 0)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    found = ann.nearest(vectors, every=10, k=7).toPandas()
    good = {(i, i % 3, 1) for i in range(30)}
    for query in (0, 10, 20):
        q = (query % 3, 1)
        best = sorted((-(a * q[0] + b * q[1]), i) for i, a, b in good if i != query)[:7]
        mine = found[found.query_id == query].sort_values("rank")
        assert list(zip(-mine.score, mine.vec_id, strict=True)) == best
    assert set(found.query_id) == {0, 10, 20}
    assert ann.nearest(vectors.limit(0)).count() == 0
    assert ann.nearest(vectors.where("vec_id <= 3"), every=1, k=20).count() == 12


def test_nearest_over_many_cells(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 64)
    monkeypatch.setattr(ann, "QUERY_ROWS", 8)
    rng = np.random.default_rng(3)
    matrix = rng.standard_normal((1200, 16)) * rng.uniform(0.5, 2, (1200, 1))
    matrix[300:700] = matrix[299]
    rows = [(i, v.tolist()) for i, v in enumerate(matrix)]
    found = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).toPandas()
    hits = 0
    for query in range(0, 1200, 20):
        scores = matrix @ matrix[query]
        scores[query] = -np.inf
        best = np.lexsort((np.arange(1200), -scores.round(9)))[:20]
        hits += len(set(best) & set(found[found.query_id == query].vec_id))
    assert hits >= 0.9 * 20 * 60


# --- decontamination ------------------------------------------------------------------------

ITEM = "Every word of this long item but the very last one can be found here in one document: "


@pytest.fixture(scope="module")
def benchmark_rows(spark, odd):
    items = [
        (1, "The quick brown fox jumps over the lazy dog near the river bank today"),
        (2, "four words are few"),
        (3, None),
        (4, "entirely other words that no document of this table ever holds"),
        (5, ITEM + "end"),
    ]
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("broadcast", [True, False])
def test_decontamination(spark, odd, none, benchmark_rows, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    more = spark.createDataFrame([(50, "Lead in. " + ITEM + "here. And out.")], "doc_id long, text string")
    docs = odd.unionByName(more, allowMissingColumns=True)
    found = decontaminate.contaminated(docs, benchmark_rows).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(1, 1), (2, 1), (50, 5)]
    assert {r.doc_id: r.start for r in found} == {1: 0, 2: 0, 50: 2}
    left = decontaminate.decontaminate(docs, benchmark_rows)
    assert left.columns == docs.columns
    gone = docs.exceptAll(left).select("doc_id").collect()
    assert sorted(r.doc_id for r in gone) == [1, 2, 50]
    assert left.count() == docs.count() - 3
    assert decontaminate.contaminated(none, benchmark_rows).count() == 0
    assert decontaminate.decontaminate(odd, benchmark_rows.limit(0)).count() == odd.count()


@pytest.mark.parametrize("broadcast", [True, False])
def test_own_words_of_templated_items(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    template = " ".join(f"frame{k}" for k in range(100))
    own = [" ".join(f"q{i}x{k}" for k in range(40)) for i in range(60)]
    items = [(i, f"{template} {words}") for i, words in enumerate(own)]
    texts = [f"lead in words {words} and out" for words in own]
    texts += [f"{template} other words than any item", f"{own[0]} {own[1]}", f"{own[2][:150]} {own[3]}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    connection = duckdb.connect()
    connection.register("documents", docs.toPandas())
    connection.register("benchmark", benchmark.toPandas())
    columns, rows = spark_rows(decontaminate.contaminated(docs, benchmark).drop("text_key"))
    assert (columns, rows) == oracle_rows(connection, queries.OP2_SQL)
    assert len(rows) >= 63


def test_fingerprints_within_the_radius_meet(spark):
    """Against all pairs: whatever bits differ, pairs of one length within the radius meet, others don't."""
    rng = random.Random(6)
    items, windows = [], []
    for number in range(60):
        bits = [rng.getrandbits(64), rng.getrandbits(64)]
        items.append((number, 20 + number % 2, *(b - (1 << 63) for b in bits)))
        for wrong in (0, 10, 30, 46, 47, 48, 60):
            flipped = sum(1 << bit for bit in rng.sample(range(128), wrong))
            changed = (bits[0] ^ (flipped >> 64), bits[1] ^ (flipped & ((1 << 64) - 1)))
            windows.append((len(windows), 20 + number % 2, *(b - (1 << 63) for b in changed)))
    columns = "item long, length int, f0 long, f1 long"
    index = decontaminate.index_of(spark.createDataFrame(items, columns))
    prints = spark.createDataFrame(windows, columns.replace("item", "window"))
    found = {(r.window, r.item) for r in decontaminate.meet(prints, index).collect()}
    mask = (1 << 64) - 1
    expected = {
        (w, i)
        for w, n, a, b in windows
        for i, m, c, d in items
        if n == m and ((a ^ c) & mask).bit_count() + ((b ^ d) & mask).bit_count() <= decontaminate.RADIUS
    }
    assert found == expected and len(expected) >= 300


def test_edited_quotes_of_templated_items_are_found(spark):
    """Items that share a template; quotes with words changed up to the threshold: recall by OP2_SQL."""
    rng = random.Random(9)
    frame = [f"frame{k}" for k in range(30)]
    items, texts = [], []
    for i in range(120):
        own = [f"q{i}x{k}" for k in range(rng.randrange(12, 50))]
        words = frame[: rng.randrange(0, 30)] + own
        items.append((i, " ".join(words)))
        for _ in range(3):
            quote = list(words)
            for _ in range(rng.randrange(0, 1 + len(own) // 20)):
                quote[rng.randrange(len(quote))] = f"new{rng.randrange(10**6)}"
            texts.append(" ".join([*(f"lead{k}" for k in range(rng.randrange(5))), *quote, "out"]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    connection = duckdb.connect()
    connection.register("documents", docs.toPandas())
    connection.register("benchmark", benchmark.toPandas())
    expected = set(oracle_rows(connection, queries.OP2_SQL)[1])
    found = set(spark_rows(decontaminate.contaminated(docs, benchmark).drop("text_key"))[1])
    assert found <= expected and len(found) >= 0.99 * len(expected) and len(expected) > 250


def test_short_items_are_one_run(spark):
    items = [(1, "Name the capital city"), (2, "few words"), (3, "请解释为什么天空在白天看起来是蓝色的而在傍晚变红"), (4, "Photosynthesis?  Chlorophyll")]
    texts = ["please NAME the capital, city now", "few words", "问：请解释为什么天空在白天看起来是蓝色的而在傍晚变红。", "photosynthesis and chlorophyll",
             "Photosynthesis, chlorophyll", "name the capital", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id, r.start, r.n_words, r.similarity) for r in found} == {
        (0, 1, 1, 4, 1.0), (2, 3, 1, 1, 1.0), (4, 4, 0, 2, 1.0),
    }
    assert decontaminate.decontaminate(docs, benchmark).count() == 4


# --- personal data --------------------------------------------------------------------------


def test_personal_data(odd, none, table):
    rows = pii.find(odd).collect()
    assert len(rows) == len(table)
    digests = sorted(
        hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in base_spans(text or "")).encode()).hexdigest()
        for text in table.text
    )
    assert digests == sorted(row.base_sha256 for row in rows)
    assert pii.find(none).count() == 0
    clean = pii.redact(odd)
    assert clean.columns == odd.columns
    kept = {row.key: row.text for row in clean.collect()}
    assert kept[2] is None
    assert kept[8].endswith("card [CARD] mail [EMAIL] ip [IP] phone [PHONE]")
    assert kept[0] == table[table.key == 0].text.item()


def test_places_in_long_texts(spark):
    text = "é𝔘 " + " ".join(f"{i % 300}.1.2.3" for i in range(2000)) + " " + "9" * 50000 + "a" * 50000
    rows = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = pii.find(rows).collect()
    listed = ",".join(f"{k}:{a}:{b}" for a, _, b, k in base_spans(text))
    assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()


def test_contexts_discover_identifiers(spark):
    rng = random.Random(5)
    known = [f"client 10.{rng.randrange(256)}.{rng.randrange(256)}.{k} came" for k in range(40)]
    rows = [*known, "client 910.2.3.4444 came", "version 910.2.3.4444x is out", "client none came"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {row.doc_id: row for row in pii.find(docs).collect()}
    assert found[40].spans == "identifier:7:19"
    assert found[41].spans == "" and found[42].spans == ""


def test_contexts_are_the_words_before(spark):
    phones = [f"call +1 ({100 + k}) 555-{1000 + 7 * k} now" for k in range(40)]
    opening = [f"10.1.{k}.7 opens" for k in range(20)]
    badges = [f"badge77 10.2.{k}.7 in" for k in range(20)]
    wide = [f"host{' ' * 70}10.3.{k}.7 in" for k in range(20)]
    long = [f"a{'x' * 70} 10.4.{k}.7 in" for k in range(20)]
    more = ["2019-2020 2021-2022", "910.2.3.4441 opens", "badge77 910.2.3.4442 in", "other88 910.2.3.4443 in"]
    more += [f"host{' ' * 70}910.2.3.4444 in", f"b{'x' * 70} 910.2.3.4445 in", f"a{'x' * 70} 910.2.3.4446 in"]
    rows = [*phones, *opening, *badges, *wide, *long, *more]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {rows[row.doc_id]: row.spans for row in pii.find(docs).collect()}
    places = ["", "", "identifier:8:20", "", "identifier:74:86", "", "identifier:72:84"]
    assert [found[text] for text in more] == places


def bootstrap(texts):
    """The pattern-instance graph in plain Python, to a fixed point: spans added to each text."""
    places = []
    for number, text in enumerate(texts):
        spans, before = base_spans(text), ""
        for match in re.finditer(r"\S+", text):
            word = match[0]
            if len(word) >= 5 and re.search("[0-9]", word):
                core = re.sub(r"^[^\w]*|[^\w]+$", "", word)
                start = match.start() + word.index(core)
                end = start + len(core)
                shape = re.sub("[0-9]+", "9", re.sub(r"[^\W\d_]+", "a", word))
                seed = any(b < end and e > start for b, _, e, _ in spans)
                if len(core) >= 5:
                    places.append((number, start, end, core, (before.lower(), shape), seed))
            before = word
    edges = {}
    for _, _, _, core, pattern, seed in places:
        edges[pattern, core] = max(edges.get((pattern, core), 0), int(seed))
    score = {}
    for (_, core), seed in edges.items():
        score[core] = max(score.get(core, 0.0), float(seed))
    while True:
        held = {}
        for pattern, core in edges:
            held.setdefault(pattern, []).append(score[core])
        trusted = {
            p: sum(v) / len(v)
            for p, v in held.items()
            if p[0] and sum(v) / len(v) >= pii.CONFIDENCE and sum(x >= pii.CONFIDENCE for x in v) >= pii.SUPPORT
        }
        lifted = dict.fromkeys(score, 0.0)
        for (pattern, core), seed in edges.items():
            lifted[core] = max(lifted[core], float(seed), trusted.get(pattern, 0.0))
        if lifted == score:
            break
        score = lifted
    return sorted((n, f"identifier:{a}:{b}") for n, a, b, _, pattern, seed in places if not seed and pattern in trusted)


def test_patterns_are_found_to_the_end_of_every_chain(spark):
    """Each pattern shares identifiers with the one before: the last one is seven rounds away."""
    rng = random.Random(4)
    texts = [f"w0 10.{rng.randrange(256)}.7.{k % 256} seen" for k in range(60)]
    words = [[f"id{step}x{k}y{k * k}" for k in range(8)] for step in range(8)]
    texts += [f"w0 {word} seen" for word in words[0][:6]]
    texts = [t.replace("id0x", "10.9.9.").replace("y", "00") if "id0x" in t else t for t in texts]
    for k in range(40):
        texts.append(f"w1 10.{rng.randrange(256)}.8.{k} seen")
    shape = "key{}-{}"
    for step in range(1, 8):
        names = [shape.format(chr(96 + step) * 2, 100 + k) for k in range(9)]
        # Most of a step's identifiers are known from the step before, the rest lead to the next one.
        earlier = [shape.format(chr(95 + step) * 2, 100 + k) for k in range(9)] if step > 1 else []
        texts += [f"w{step + 1} {name} seen" for name in [*earlier, *names[:4]]]
        if step == 1:
            texts += [f"w2 10.{rng.randrange(256)}.9.{k} key" for k in range(3)]
            texts += [f"mail{k}@example.org" for k in range(3)]
        texts += [f"w{step + 2} {name} seen" for name in names[:4]]
    texts += ["x" * 100 + "1 alone", f"w1 910.2.3.{'4' * 80} seen"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = [
        (row.doc_id, span)
        for row in pii.find(docs).collect()
        for span in row.spans.split(",")
        if span.startswith("identifier")
    ]
    assert sorted(found) == bootstrap(texts)


def test_a_chain_of_patterns(spark):
    """Base spans trust w0, whose other words trust w1, and so on: w6 takes more than six rounds."""
    texts = [f"w0 10.{k % 256}.2.{k // 256} on" for k in range(3000)]
    for step in range(7):
        words = [f"9{step}0.1.2.{k}" for k in range(256 >> step)]
        texts += [f"w{at} {word} on" for word in words for at in (step, step + 1)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = [
        (row.doc_id, span)
        for row in pii.find(docs).collect()
        for span in row.spans.split(",")
        if span.startswith("identifier")
    ]
    expected = bootstrap(texts)
    assert sorted(found) == expected
    assert {texts[number].split()[0] for number, _ in expected} == {f"w{k}" for k in range(8)}


# --- quality --------------------------------------------------------------------------------


def test_quality(odd, none, labels, table):
    rows = quality.score(odd, labels).toPandas()
    assert len(rows) == len(table)
    assert rows.score.between(0, 1).all()
    names = ["" if np.isnan(d) else str(int(d)) for d in table.doc_id]
    folds = sorted(zlib.crc32(name.encode()) % 5 == 0 for name in names)
    assert sorted(rows.held_out) == folds
    assert rows[rows.doc_id.isin([3, 4])].score.nunique() == 1
    assert quality.score(none, labels).count() == 0
    assert set(quality.score(odd, labels.limit(0)).toPandas().score) == {0.5}
    assert quality.keep_good(odd, labels).columns == odd.columns
    assert quality.keep_good(none, labels).count() == 0


def test_prior_is_estimated():
    rng = np.random.default_rng(1)
    good = rng.normal(1.5, 1, (3000, 4))
    mixed = np.concatenate([rng.normal(1.5, 1, (2100, 4)), rng.normal(-1.5, 1, (900, 4))])
    model = quality.fit(good, mixed)
    assert 0.6 <= model.prior <= 0.8
    scores = model.score(mixed)
    assert (scores[:2100] >= 0.3).mean() > 0.95 and (scores[2100:] < 0.3).mean() > 0.9


# --- near duplicates ------------------------------------------------------------------------


def _closed(pairs, docs):
    root = {doc: doc for doc in docs}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


@pytest.mark.parametrize("forced", [False, True])
def test_near_duplicates_of_a_large_group(spark, monkeypatch, forced):
    if forced:
        monkeypatch.setattr(neardup, "BROADCAST_IDS", 0)
    rng = random.Random(2)
    base = [f"b{k}" for k in range(120)]
    texts = []
    for _ in range(90):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 4, 6, 8])):
            words[rng.randrange(120)] = f"n{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    texts += [" ".join(f"u{rng.randrange(10**6)}" for _ in range(50)) for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in neardup.link_groups(docs, 3, 85).collect()}
    assert found == _closed(near_pairs(docs.toPandas(), 3, 85), range(len(texts)))


def test_near_duplicates_of_odd_rows(odd, none, table):
    rows = neardup.link_groups(odd, 3, 85).toPandas()
    assert len(rows) == len(table)
    of = rows.dropna(subset=["doc_id"]).drop_duplicates("doc_id").set_index("doc_id")
    assert of.component_id[2] == 1 and not of.kept[2] and of.kept[1]
    assert (of.n_shingles[[3, 4, 5]] == 0).all() and of.kept[[3, 4, 5]].all()
    assert of.component_id[7] == 6 and of.n_shingles[7] == 1
    assert neardup.link_groups(none).count() == 0
    left = neardup.keep_one(odd, 3, 85)
    assert left.columns == odd.columns
    ids = sorted(r.doc_id or 0 for r in left.collect())
    assert ids.count(7) == 0 and ids.count(11) >= 1 and ids.count(0) == 1
    assert neardup.keep_one(none).count() == 0


def test_signature_distance():
    assert neardup.chunks_needed(0.85) <= neardup.chunks_needed(0.8) <= neardup.CHUNKS
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 62, 4000).astype(np.uint64)
    b = np.concatenate([a[:3700], rng.integers(0, 1 << 62, 300).astype(np.uint64)])
    x, y = (neardup.signature(np.unique(v)).view(np.uint16) for v in (a, b))
    assert (x != y)[: neardup.chunks_needed(0.85) * neardup.LANES].sum() <= neardup.radius(0.85)


def test_signatures_within_the_radius_share_a_key(spark):
    """Random signatures at every distance up to the radius, against the distances of all pairs."""
    rng = np.random.default_rng(1)
    for similarity in (0.85, 0.8):
        chunks, limit = neardup.chunks_needed(similarity), neardup.radius(similarity)
        lanes = chunks * neardup.LANES
        pairs = []
        for wrong in range(limit + 3):
            for _ in range(8):
                x = rng.integers(0, 1 << 16, neardup.SYMBOLS).astype(np.uint16)
                y = x.copy()
                y[rng.permutation(lanes)[:wrong]] ^= 1
                y[lanes:] ^= rng.integers(0, 2, neardup.SYMBOLS - lanes).astype(np.uint16)
                pairs.append((wrong, x.view(np.int64).tolist(), y.view(np.int64).tolist()))
        df = spark.createDataFrame(pairs, "wrong int, x array<bigint>, y array<bigint>")
        shared = F.arrays_overlap(neardup._keys(chunks, "x"), neardup._keys(chunks, "y"))
        apart = neardup._differing(F.col("x"), F.col("y"), chunks)
        rows = df.select("wrong", shared.alias("shared"), apart.alias("apart")).collect()
        assert all(row.apart == row.wrong for row in rows)
        assert all(row.shared for row in rows if row.wrong <= limit)


def test_tiers_are_packed_to_their_own_length():
    """Every tier has full windows, no id is lost, and only the last sequence may be padded."""
    rng = random.Random(3)
    tiers = packing.Tiers(packing.tiers_of(1024, 64))
    waiting = 0
    for number in range(3000):
        length = rng.randrange(1, 1024)
        waiting += length
        tiers.add((length, number, number, 0, length, np.arange(length)))
    windows = [*packing.pack_tiers(tiers, 0), *packing.pack_rest(tiers)]
    sums = [(size, sum(piece[0] for piece in window)) for size, window in windows]
    assert sum(total for _, total in sums) == waiting
    assert all(size == total for size, total in sums[:-1])
    full = {size: sum(s == size for s, _ in sums) for size in tiers.sizes}
    assert all(full[size] > 10 for size in (1024, 512, 256, 128))
    pieces = {}
    for _, window in windows:
        for length, number, _, start, total, ids in window:
            assert ids.tolist() == list(range(start, start + length))
            pieces.setdefault((number, total), []).append((start, length))
    assert len(pieces) == 3000
    for (_, total), parts in pieces.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == total


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 100), (70, 71)], "a long, b long")
    found = {r.node: r.root for r in components.components(links).collect()}
    assert found == {**{k: 0 for k in range(1, 61)}, 71: 70}


# --- conversations --------------------------------------------------------------------------


def test_snapshots_collapse(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART_TURNS", 2)
    long = [("system", "be kind"), ("user", "hi <|im_end|>"), ("assistant", "hello"), ("user", None), (None, "x")]

    def turns(conv, part, first=0):
        return [(conv, first + k, role, text, 1) for k, (role, text) in enumerate(part)]

    rows = turns(1, long[:2]) + turns(2, long) + turns(3, long) + turns(4, long[:4])
    rows += turns(5, [("user", "hi <|im_end|>")]) + turns(6, long[:3] + [("user", "other")])
    rows += turns(2, long[:1]) + [(None, 0, "user", "lost", 1), (7, None, "user", "no number", 1)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part int")
    found = chat.collapse(table).collect()
    assert {r.conv_id: (r.n_turns, r.copies) for r in found} == {2: (5, 2), 5: (1, 1), 6: (4, 1), 7: (1, 1)}
    whole = "".join(r.text for r in sorted(found, key=lambda r: r.part) if r.conv_id == 2)
    assert whole == (
        "<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>user\nhi < |im_end|><|im_end|>\n"
        "<|im_start|>assistant\nhello<|im_end|>\n<|im_start|>user\n<|im_end|>\n<|im_start|>\nx<|im_end|>\n"
    )
    assert chat.collapse(table.limit(0)).count() == 0


# --- licences -------------------------------------------------------------------------------


def test_licenses_of_odd_rows(odd, none, table):
    rows = licenses.scan(odd).collect()
    assert len(rows) == len(table)
    (row,) = [r for r in rows if r.doc_id == 9]
    assert (row.n_base, row.labels, row.first_word, row.last_word) == (2, "apache,mit", 3, 8)
    assert all(r.n_words == 0 and r.score == 0 for r in rows if r.doc_id in (3, 4, 5))
    assert licenses.scan(none).count() == 0


def test_mandatory_part_is_needed(spark):
    texts = [
        "Permission is hereby granted, free of charge, to any person obtaining a copy",
        "Permission is hereby granted, for a charge, to any person obtaining a copy",
        "Redistribution and use in source and binary forms, with or without modification",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.labels for r in licenses.scan(docs).collect()} == {0: "mit", 1: "", 2: "bsd"}


# --- token files and packing ----------------------------------------------------------------


def test_token_files_of_odd_rows(spark, odd, none, table, tokenizer, encoder, tmp_path):
    planes.write_ids(odd, str(tmp_path / "ids"), tokenizer)
    rows = planes.read_ids(spark, str(tmp_path / "ids")).orderBy("start").collect()
    ordered = sorted(zip(table.doc_id, table.text, strict=True), key=lambda r: (r[0] == r[0], r[0], r[1] or ""))
    expected = [np.array(encoder(text), dtype="<u4").tobytes() for _, text in ordered]
    assert [bytes(r.ids) for r in rows] == expected
    assert [r.start for r in rows] == np.cumsum([0, *(len(x) // 4 for x in expected)])[:-1].tolist()
    planes.write_ids(none, str(tmp_path / "none"), tokenizer)
    assert planes.read_ids(spark, str(tmp_path / "none")).count() == 0


def test_planes_of_large_ids():
    import zstandard

    rng = np.random.default_rng(1)
    ids = rng.integers(0, 1 << 32, 40001, dtype=np.uint32)
    sizes, payload = planes.pack_planes(ids, zstandard.ZstdCompressor())
    assert len(sizes) == 4 * 3
    back = planes.unpack_planes(len(ids), sizes, payload, zstandard.ZstdDecompressor())
    assert (back == ids).all()


@pytest.mark.parametrize("context,shortest,pool", [(1024, 64, 4096), (64, 8, 16)])
def test_packing_of_odd_rows(spark, odd, none, table, tokenizer, encoder, monkeypatch, context, shortest, pool):
    from pyspark.sql import functions as F

    monkeypatch.setattr(packing, "POOL", pool)
    numbered = odd.drop("doc_id").withColumnRenamed("key", "doc_id")
    pieces = packing.pack(numbered, tokenizer, context, shortest).withColumn("ids_crc32", F.crc32("ids"))
    encoded = {k: np.array(encoder(t), dtype="<u4") for k, t in zip(table.key, table.text, strict=True)}
    assert check_packing(pieces.toPandas(), encoded, context) <= 3 * context
    assert packing.pack(none, tokenizer).count() == 0
    assert packing.pack(odd, tokenizer).where("doc_id IS NULL").count() >= 1


# --- substrings -----------------------------------------------------------------------------


def test_cover_has_every_difference():
    differences = {(a - b) % substring.PERIOD for a in substring.COVER for b in substring.COVER}
    assert differences == set(range(substring.PERIOD))


@pytest.mark.parametrize("broadcast", [True, False])
def test_repeats_of_odd_rows(odd, none, table, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(substring, "BROADCAST_KEYS", 0)
    rows = substring.remove_repeats(odd).collect()
    words = [(d, (t or "").encode().split()) for d, t in zip(table.doc_id, table.text, strict=True)]
    first = {}
    for doc, w in words:
        for k in range(len(w) - 49):
            if doc == doc:
                run = tuple(w[k : k + 50])
                first[run] = min(doc, first.get(run, doc))
    expected = []
    for doc, w in words:
        gone = set()
        for k in range(len(w) - 49):
            if first.get(tuple(w[k : k + 50]), doc) < doc:
                gone |= set(range(k, k + 50))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        expected.append((str(doc), len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    found = [
        (str(float("nan") if r.doc_id is None else float(r.doc_id)), r.n_words, r.n_removed, r.kept_sha256)
        for r in rows
    ]
    assert sorted(found) == sorted(expected)
    assert any(r.n_removed for r in rows)
    assert substring.remove_repeats(none).count() == 0
