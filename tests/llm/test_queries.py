"""Registered queries against their SQL statements or brute force over the whole generated tables."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from compare import oracle_connection, oracle_rows, spark_rows

from kedai.llm import licenses, queries

QUERIES = queries.queries()


@pytest.fixture(scope="module")
def oracle(sf_dir):
    connection = oracle_connection(sf_dir)
    yield connection
    connection.close()


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return {row.doc_id: row.text or "" for row in rows}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_oracle(name, spark, sf_dir, oracle):
    columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
    assert (columns, rows) == oracle_rows(oracle, queries.oracle_sql()[name])
    assert rows


def test_nearest_has_recall(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas().sort_values("vec_id")
    vectors, ids = np.array(table.embedding.tolist(), dtype=np.float64), table.vec_id.to_numpy()
    found = QUERIES["op1_nearest"](spark, sf_dir).toPandas()
    hits = total = 0
    for at in np.flatnonzero(ids % 20 == 0):
        scores = vectors @ vectors[at]
        scores[at] = -np.inf
        best = ids[np.lexsort((ids, -scores))[:20]]
        mine = found[found.query_id == ids[at]].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 21))
        assert np.allclose(mine.score, vectors[mine.vec_id] @ vectors[at], atol=1e-12)
        hits, total = hits + len(set(best) & set(mine.vec_id)), total + 20
    assert hits >= 0.9 * total


def _luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 * (x > 9) for x in doubled) % 10 == 0


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    def valid(kind, found):
        digits = re.sub("[^0-9]", "", found)
        return {
            "email": True,
            "ip": kind != "ip" or all(int(part) <= 255 for part in found.split(".")),
            "card": 12 <= len(digits) <= 19 and _luhn(digits),
            "phone": 9 <= len(digits) <= 15,
        }[kind]

    return sorted(
        (m.start(), list(BASE).index(kind), m.end(), kind)
        for kind, pattern in BASE.items()
        for m in re.finditer(pattern, text)
        if valid(kind, m[0])
    )


def test_personal_data(spark, sf_dir, texts):
    rows = QUERIES["op3_personal_data"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        spans = base_spans(texts[row.doc_id])
        listed = ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in spans)
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [row[f"n_{kind}"] for kind in BASE] == [sum(s[3] == k for s in spans) for k in BASE]
        assert set(listed.split(",")) - {""} <= set(row.spans.split(","))


def test_quality_held_out(spark, sf_dir):
    # The larger table: small ones have too few held-out labels.
    big = sf_dir.replace("sf0.001", "sf0.01")
    rows = QUERIES["op4_quality"](spark, big).toPandas()
    labels = spark.read.parquet(f"{big}/labels.parquet").toPandas()
    assert rows.score.between(0, 1).all()
    assert (rows.held_out == [zlib.crc32(str(d).encode()) % 5 == 0 for d in rows.doc_id]).all()
    assert (rows.predicted == (rows.score >= 0.3)).all()
    held = rows[rows.held_out].merge(labels, on="doc_id")
    assert (held.predicted == held.quality).mean() >= 0.95


def test_license_scan(spark, sf_dir, texts):
    rows = QUERIES["op7_license_scan"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), texts[row.doc_id])
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

        def stands(phrase, words=words):
            part = phrase.split()
            return [k for k in range(len(words)) if words[k : k + len(part)] == part]

        base = [(k, label) for phrase, label in licenses.BASE for k in stands(phrase)]
        own = {label for label, _, key in licenses.TEMPLATES if stands(key)}
        places = [k for k, _ in base]
        assert (row.n_words, row.n_base) == (len(words), len(base))
        assert (row.first_word, row.last_word) == (min(places, default=None), max(places, default=None))
        assert row.base_labels == ",".join(sorted({label for _, label in base}))
        assert row.labels == ",".join(sorted({label for _, label in base} | own))
        assert 0 <= row.score <= 1


@pytest.fixture(scope="module")
def encoded(texts, tokenizer):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(tokenizer)
    return {
        doc: np.array(encoder.encode(text, add_special_tokens=False).ids + [0], dtype="<u4")
        for doc, text in texts.items()
    }


def test_token_planes(spark, sf_dir, encoded):
    rows = {row.doc_id: row for row in QUERIES["op8_token_planes"](spark, sf_dir).collect()}
    start = 0
    for doc in sorted(encoded):
        ids = encoded[doc]
        expected = (start, len(ids), zlib.crc32(ids.tobytes()))
        assert (rows[doc].start, rows[doc].n_tokens, rows[doc].ids_crc32) == expected
        start += len(ids)


def check_packing(pieces, encoded, context=1024):
    """Every id lies in one piece, sequences are gapless and little is padded."""
    for row in pieces.itertuples():
        part = encoded[row.doc_id][row.start : row.start + row.length]
        assert len(part) == row.length
        assert zlib.crc32(part.tobytes()) == row.ids_crc32
        assert row.doc_tokens == len(encoded[row.doc_id])
    for key, at in (("doc_id", "start"), ("sequence_id", "offset")):
        ordered = pieces.sort_values([key, at])
        assert (ordered.groupby(key).length.cumsum() - ordered.length == ordered[at]).all()
    assert pieces.groupby("doc_id").length.sum().to_dict() == {d: len(i) for d, i in encoded.items()}
    sizes = pieces.groupby("sequence_id").length.sum()
    assert sizes.max() <= context
    return sum(0 if size & (size - 1) == 0 else context - size for size in sizes)


def test_packing(spark, sf_dir, encoded):
    pieces = QUERIES["op10_packing"](spark, sf_dir).toPandas()
    assert check_packing(pieces, encoded) <= 1024  # one input partition


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline
    from kedai.llm.common import read_table, store

    docs = read_table(spark, sf_dir, "documents")
    kept = [docs.toPandas()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
        kept.append(docs.toPandas())
        assert list(kept[-1].columns) == list(kept[0].columns)
        assert set(kept[-1].doc_id) <= set(kept[-2].doc_id)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas().set_index("doc_id").quality
    assert not [d for d in kept[1].doc_id if labels.get(d) == 0]
    near = near_pairs(kept[1], 5, 80)
    assert not [(a, b) for a, b in near if {a, b} <= set(kept[2].doc_id)]
    linked = {x for pair in near for x in pair}
    assert set(kept[1].doc_id) - set(kept[2].doc_id) <= linked
    gone = set(kept[2].doc_id) - set(kept[3].doc_id)
    held = {row.doc_id for row in QUERIES["op2_decontamination"](spark, sf_dir).collect()}
    assert gone == held & set(kept[2].doc_id)
    assert set(kept[4].doc_id) == set(kept[3].doc_id)
    assert not [t for t in kept[4].text if base_spans(t)]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).toPandas()
    assert set(pieces.doc_id) == set(kept[4].doc_id)


def near_pairs(table, size, percent):
    """All pairs of documents with similar sets, counted over shared shingles."""
    sets, holders = {}, {}
    for doc, text in zip(table.doc_id, table.text, strict=True):
        words = (text or "").encode().lower().split()
        n = min(size, len(words))
        sets[doc] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if words else set()
        for shingle in sets[doc]:
            holders.setdefault(shingle, []).append(doc)
    seen = {(a, b) for docs in holders.values() for i, a in enumerate(docs) for b in docs[i + 1 :]}
    return [
        (a, b)
        for a, b in seen
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
