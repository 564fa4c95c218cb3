"""The operators as registered queries over the generated tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kedai.llm import (
    ann,
    chat,
    decontaminate,
    jaccard,
    licenses,
    neardup,
    packing,
    pii,
    planes,
    quality,
    ranking,
    substring,
    whitening,
)
from kedai.llm.common import read_table
from kedai.session import work_path

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def tokenizer_file() -> str:
    """The public tokenizer of the registered queries; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows, by inner product, of every embedding whose id is divisible by 20."""
    return ann.nearest(read_table(spark, sf_dir, "embeddings"))


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item and the place."""
    docs, benchmark = (read_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontaminate.contaminated(docs, benchmark).drop("text_key")


@query
def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return pii.find(read_table(spark, sf_dir, "documents"))


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learnt outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents")
    return quality.score(docs, read_table(spark, sf_dir, "labels"))


@query
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose sets of 3-word shingles have 85 hundredths in common."""
    return neardup.link_groups(read_table(spark, sf_dir, "documents"), size=3, percent=85)


@query
def op6_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations that are no snapshot of a longer one, rendered for training."""
    return chat.collapse(read_table(spark, sf_dir, "conversations"))


@query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences named or quoted in every document."""
    return licenses.scan(read_table(spark, sf_dir, "documents"))


@query
def op8_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents through plane files and back; null texts are empty."""
    path = work_path(spark, "token-planes")
    planes.write_ids(read_table(spark, sf_dir, "documents"), path, tokenizer_file())
    return planes.read_ids(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


@query
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of every document when windows of 50 words that an earlier one has are cut."""
    return substring.remove_repeats(read_table(spark, sf_dir, "documents")).drop("kept")


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 ids; null texts are empty."""
    pieces = packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_file())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 32 whitened components of every embedding."""
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 documents that rank highest for every benchmark item."""
    docs, benchmark = (read_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return ranking.rank(docs, benchmark)


@query
def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose sets of 3-word shingles have 90 hundredths in common."""
    return jaccard.join_groups(read_table(spark, sf_dir, "documents"), size=3, percent=90)


# Pairs that share a shingle, counted shingle by shingle, then closed over links: small inputs only.
OP5_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)] END) AS s FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingles x JOIN shingles y
  ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared s JOIN sizes p ON a = p.doc_id JOIN sizes q ON b = q.doc_id
  WHERE 100 * s.n >= 85 * (p.n + q.n - s.n)
), edges AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION
  SELECT reach.doc_id, e.b FROM reach JOIN edges e ON reach.r = e.a
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM documents d JOIN (SELECT doc_id, min(r) AS c FROM reach GROUP BY doc_id) m ON d.doc_id = m.doc_id
LEFT JOIN sizes s ON d.doc_id = s.doc_id
"""

# All windows that share a shingle with an item, without fingerprints.
OP2_SQL = r"""
WITH items AS (
  SELECT item_id, [w FOR w IN regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+') IF w <> ''] AS words
  FROM benchmark
), docs AS (
  SELECT doc_id, [w FOR w IN regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+') IF w <> ''] AS words
  FROM documents
), postings AS (
  SELECT item_id, len(words) AS length, i - 1 AS place, array_to_string(words[i:i + 4], ' ') AS shingle
  FROM (SELECT *, unnest(range(1, len(words) - 3)) AS i FROM items WHERE len(words) >= 5)
), weights AS (
  SELECT shingle, 1.0::DOUBLE / count(DISTINCT item_id) AS weight FROM postings GROUP BY shingle
), weighted AS (
  SELECT DISTINCT item_id, shingle, weight FROM postings JOIN weights USING (shingle)
), whole AS (
  SELECT item_id, sum(weight) AS weight FROM weighted GROUP BY item_id
), spots AS (
  SELECT doc_id, i - 1 AS place, array_to_string(words[i:i + 4], ' ') AS shingle
  FROM (SELECT *, unnest(range(1, len(words) - 3)) AS i FROM docs WHERE len(words) >= 5)
), windows AS (
  SELECT DISTINCT s.doc_id, p.item_id, s.place - p.place AS start, p.length
  FROM spots s JOIN postings p ON s.shingle = p.shingle
), held AS (
  SELECT DISTINCT w.doc_id, w.item_id, w.start, w.length, s.shingle FROM windows w
  JOIN spots s ON s.doc_id = w.doc_id AND s.place >= w.start AND s.place + 5 <= w.start + w.length
), scored AS (
  SELECT h.doc_id, h.item_id, h.start, h.length, round(sum(x.weight) / any_value(t.weight), 6) AS similarity
  FROM held h JOIN weighted x ON x.item_id = h.item_id AND x.shingle = h.shingle
  JOIN whole t ON t.item_id = h.item_id GROUP BY ALL
), best AS (
  SELECT * FROM scored WHERE similarity >= 0.8
  QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
)
SELECT doc_id, item_id, CAST(start AS INTEGER) AS start,
  CAST(least(start + length, len(words)) - greatest(start, 0) AS INTEGER) AS n_words, similarity
FROM best JOIN docs USING (doc_id)
"""

# Conversations as lists of turns, compared pair by pair: small inputs only.
OP6_SQL = r"""
WITH turns AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), whole AS (
  SELECT conv_id, list({'turn': turn, 'role': role, 'text': text}
    ORDER BY turn NULLS FIRST, role, text) AS l FROM turns GROUP BY conv_id
), classes AS (
  SELECT min(conv_id) AS conv_id, count(*) AS copies, l FROM whole GROUP BY l
), longest AS (
  SELECT conv_id, copies, len(l) AS n_turns FROM classes a WHERE NOT EXISTS (
    SELECT 1 FROM classes b WHERE len(b.l) > len(a.l) AND b.l[1:len(a.l)] = a.l)
)
SELECT conv_id, CAST(coalesce(floor(turn / 1024), -18014398509481984) AS BIGINT) AS part, n_turns, copies,
  string_agg('<|im_start|>' || replace(role, '<|', '< |') || chr(10) || replace(text, '<|', '< |')
    || '<|im_end|>' || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS text
FROM turns JOIN longest USING (conv_id) GROUP BY ALL
"""

# Every window as text: one row per window of 50 words, so for small inputs only.
OP9_SQL = r"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), spans AS (
  SELECT row, doc_id, unnest(range(1, len(words) - 48)) AS start, words FROM docs WHERE len(words) >= 50
), windows AS (
  SELECT row, doc_id, start, array_to_string(words[start:start + 49], ' ') AS run FROM spans
), cuts AS (
  SELECT row, start FROM (SELECT *, min(doc_id) OVER (PARTITION BY run) AS first FROM windows)
  WHERE first < doc_id
), covered AS (
  SELECT DISTINCT row, unnest(range(start, start + 50)) AS place FROM cuts
), gone AS (
  SELECT row, count(*) AS n, list(place) AS places FROM covered GROUP BY row
)
SELECT d.doc_id, len(words) AS n_words, coalesce(g.n, 0) AS n_removed,
  sha256(CASE WHEN g.n IS NULL THEN array_to_string(words, ' ')
    ELSE array_to_string([w FOR w, i IN words IF NOT list_contains(g.places, i)], ' ') END) AS kept_sha256
FROM docs d LEFT JOIN gone g ON d.row = g.row
"""

# Scores of every item and document that share a term.
OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), whole AS (
  SELECT count(*) FILTER (len(terms) > 0) AS documents, CAST(sum(len(terms)) AS BIGINT) AS all_terms FROM docs
), counts AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM docs)
  WHERE term IN (SELECT term FROM wanted) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * documents + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counts, whole GROUP BY term, documents
), norms AS (
  SELECT row, doc_id, 50 + (50 * len(terms) * documents) // all_terms AS m FROM docs, whole WHERE len(terms) > 0
), scores AS (
  SELECT item_id, row, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM wanted JOIN counts USING (term) JOIN weights USING (term) JOIN norms USING (row) GROUP BY ALL
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM scores WHERE score > 0
) WHERE rank <= 50
"""

# The links of OP5_SQL at another threshold.
OP13_SQL = OP5_SQL.replace("100 * s.n >= 85 *", "100 * s.n >= 90 *").replace(", d.doc_id = m.c AS kept", "")


def oracle_sql() -> dict[str, str]:
    return {
        "op2_decontamination": OP2_SQL,
        "op5_near_duplicates": OP5_SQL,
        "op6_chat_snapshots": OP6_SQL,
        "op9_substring_dedup": OP9_SQL,
        "op12_ranked_search": OP12_SQL,
        "op13_jaccard_join": OP13_SQL,
    }
