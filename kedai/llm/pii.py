"""Personal data: exact spans, and identifiers discovered by bootstrapped contextual patterns.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kedai.llm.common import store, text_or_empty

# What an entity is. Quantifiers are possessive and starts inside a run are skipped
# where that can't change a match, so that no text takes more than linear time.
_MAIL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{_MAIL})|\G){_MAIL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = [*PATTERNS, "identifier"]

# Words with a digit that may be identifiers.
TOKEN = r"(?<!\S)(?=[^\s0-9]*+[0-9])\S{5,}+(?!\S)"

# A pattern is trusted from this confidence and this many known instances on. Scoring ends when a round
# adds no pattern and lifts the patterns' confidence by no more than STILL on average.
CONFIDENCE, SUPPORT, STILL = 0.6, 3, 1e-3

# Rows of discovered spans that are broadcast at most; more are joined by shuffling.
BROADCAST_ROWS = 1 << 18

_GROUP = 256
KEY = ["doc_id", "text_key"]


def located(text: Column, pattern: str) -> Column:
    """All leftmost matches that don't overlap: array of (start, end, found, gap before).

    Matches and the gaps between them come in order, so places are running sums of their lengths;
    they are summed in groups, which keeps texts with very many matches linear.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(matches)),
        matches,
        lambda gap, found: F.struct(gap.alias("gap"), found.alias("found")),
    )
    one = "struct<start:int,end:int,found:string,gap:string>"
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{one}>").alias("out"))

    def add(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        end = start + F.length(pair["found"])
        span = F.struct(
            start.alias("start"), end.alias("end"), pair["found"].alias("found"), pair["gap"].alias("gap")
        )
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    count = F.ceil(F.size(matches) / _GROUP).cast("int")
    groups = F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda k: F.aggregate(F.slice(pairs, k * _GROUP + 1, F.lit(_GROUP)), nothing, add),
    )
    based = "struct<base:int,out:array<" + one + ">>"
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{based}>").alias("out"))
    placed = F.aggregate(
        groups,
        begin,
        lambda state, group: F.struct(
            (state["at"] + group["at"]).alias("at"),
            F.concat(
                state["out"], F.array(F.struct(state["at"].alias("base"), group["out"].alias("out")))
            ).alias("out"),
        ),
        lambda state: state["out"],
    )
    moved = F.flatten(
        F.transform(
            placed,
            lambda group: F.transform(
                group["out"],
                lambda span: F.struct(
                    (group["base"] + span["start"]).alias("start"),
                    (group["base"] + span["end"]).alias("end"),
                    span["found"].alias("found"),
                    span["gap"].alias("gap"),
                ),
            ),
        )
    )
    return F.when(F.size(matches) > 0, moved).otherwise(F.array().cast(f"array<{one}>"))


def _valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        short = lambda part: F.regexp_replace(part, "^0+(?=.)", "")
        return F.forall(
            F.split(found, r"\."),
            lambda part: (F.length(short(part)) <= 3) & (short(part).try_cast("int") <= 255),
        )
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "card":
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Array of (start, order of the kind, end, kind) of the entities that the patterns define."""

    def spans(order: int, kind: str, pattern: str) -> Column:
        return F.transform(
            F.filter(located(text, pattern), lambda span: _valid(kind, span["found"])),
            lambda span: F.struct(
                span["start"].alias("start"),
                F.lit(order).alias("kind_order"),
                span["end"].alias("end"),
                F.lit(kind).alias("kind"),
            ),
        )

    found = [spans(order, *item) for order, item in enumerate(PATTERNS.items())]
    return F.concat(*found)


def _shape(token: Column) -> Column:
    """The token with runs of digits as 9 and runs of letters as a."""
    return F.regexp_replace(F.regexp_replace(token, r"\p{L}+", "a"), "[0-9]+", "9")


def _last_word(gap: Column) -> Column:
    """The last word of a gap, empty if it has none; read backwards, which takes linear time."""
    return F.reverse(F.regexp_extract(F.reverse(gap), r"^\s*+(\S++)", 1))


def profile(rows: DataFrame) -> DataFrame:
    """Base spans of every text, and its words with digits: their cores, contexts and places.

    The context is the word before in the text, with or without digits; only a text's first word has
    none.
    """
    spotted = rows.select(
        *KEY, base_spans(F.col("text")).alias("base"), located(F.col("text"), TOKEN).alias("tokens")
    )
    edge = r"^[^\p{L}\p{N}]*"

    def occurrence(span: Column, at: Column) -> Column:
        previous = F.when(at > 0, F.get(F.col("tokens"), at - 1)["found"]).otherwise("")
        word = _last_word(span["gap"])
        core = F.regexp_replace(F.regexp_replace(span["found"], edge, ""), r"[^\p{L}\p{N}]+$", "")
        start = span["start"] + F.length(F.regexp_extract(span["found"], edge, 0))
        return F.struct(
            start.alias("start"),
            (start + F.length(core)).alias("end"),
            core.alias("instance"),
            F.lower(F.when(word != "", word).otherwise(previous)).alias("before"),
            _shape(span["found"]).alias("shape"),
        )

    return spotted.withColumn("tokens", F.transform("tokens", occurrence))


def occurrences(profiles: DataFrame) -> DataFrame:
    """Each candidate word with its pattern (word before, shape) and whether a base span covers it."""
    rows = profiles.where(F.size("tokens") > 0).select(*KEY, "base", F.explode("tokens").alias("t"))
    seed = F.expr("exists(base, b -> b.start < t.end AND b.end > t.start)")
    return rows.select(*KEY, "t.*", seed.alias("seed")).where("length(instance) >= 5")


def trusted_patterns(found: DataFrame) -> DataFrame:
    """Patterns that mostly stand before known identifiers: before, shape.

    The graph links patterns and instances. Seeds score 1. In each round a pattern's confidence is the
    mean score of its distinct instances, and an instance's score the best confidence of its trusted
    patterns; new instances may raise further patterns. Scores only rise, so rounds go on until nothing
    is added. Without a word before there is no context, so
    such places count for their instances but form no trusted pattern.
    """
    pattern = ["before", "shape"]
    edges = store(
        found.groupBy(*pattern, "instance").agg(F.max(F.col("seed").cast("int")).alias("seed")), "edges"
    )
    known = edges.groupBy("instance").agg(F.max("seed").cast("double").alias("score"))
    before = (-1, 0.0)
    while True:
        scored = edges.join(store(known, "instances"), "instance")
        sure = F.count(F.when(F.col("score") >= CONFIDENCE, True))
        trusted = store(
            scored.groupBy(*pattern)
            .agg(F.avg("score").alias("confidence"), sure.alias("support"))
            .where("before <> ''")
            .where((F.col("confidence") >= CONFIDENCE) & (F.col("support") >= SUPPORT))
            .select(*pattern, "confidence"),
            "patterns",
        )
        count, total = trusted.agg(F.count("*"), F.coalesce(F.sum("confidence"), F.lit(0.0))).first()
        if count == before[0] and total - before[1] <= STILL * count:
            return trusted.select(*pattern)
        before = (count, total)
        lifted = edges.join(trusted, pattern, "left")
        best = F.greatest(F.col("seed").cast("double"), F.coalesce("confidence", F.lit(0.0)))
        known = lifted.groupBy("instance").agg(F.max(best).alias("score"))


def discovered(profiles: DataFrame) -> DataFrame:
    """Spans of unseen identifiers by document: doc_id, text_key, added."""
    found = store(occurrences(profiles), "occurrences")
    trusted = trusted_patterns(found)
    span = F.struct(
        F.col("start"), F.lit(KINDS.index("identifier")).alias("kind_order"), F.col("end"), F.lit("identifier").alias("kind")
    )
    return (
        found.where(~F.col("seed"))
        .join(trusted, ["before", "shape"])
        .groupBy(*KEY)
        .agg(F.collect_set(span).alias("added"))
    )


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")
    ).withColumn("text_key", F.xxhash64("text"))


def _with_added(rows: DataFrame, profiles: DataFrame) -> DataFrame:
    """Rows with the discovered spans of their text, none as an empty array."""
    added = store(discovered(profiles), "discovered")
    if added.count() <= BROADCAST_ROWS:
        added = F.broadcast(added)
    names = added.select(F.col("doc_id").alias("__doc"), F.col("text_key").alias("__key"), "added")
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("text_key") == F.col("__key"))
    none = F.array().cast("array<struct<start:int,kind_order:int,end:int,kind:string>>")
    return (
        rows.join(names, same, "left")
        .drop("__doc", "__key")
        .withColumn("added", F.coalesce("added", none))
    )


def _listed(spans: Column) -> Column:
    """kind:start:end by start, then kind, comma-joined."""
    parts = F.transform(
        F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    )
    return F.array_join(parts, ",")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Personal data of every whole text: doc_id, n_email, n_ip, n_card, n_phone, n_identifier,
    base_sha256 (digest of the listed base spans) and spans (all spans, listed).

    Places are code points, ends exclusive. Base spans are the valid matches of ``PATTERNS``, found
    kind by kind. Words with digits outside them become spans of kind ``identifier`` when the pattern
    they stand in (the word before and the word's shape) is trusted, see ``trusted_patterns``.

    Null and empty texts hold nothing. Repeated rows and rows with a null id get a row each. Extra
    columns are ignored; an empty table gives an empty result. Patterns met very often are combined
    before the shuffle; only discovered spans are joined back, never texts.
    """
    profiles = store(profile(_documents(docs, id_col, text_col)), "entities")
    rows = _with_added(profiles, profiles)

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda span: span["kind"] == kind)).cast("long")

    return rows.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in PATTERNS),
        F.size("added").cast("long").alias("n_identifier"),
        F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.concat("base", "added")).alias("spans"),
    )


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with every span replaced by its kind in brackets; other columns as they were.

    Spans that overlap are replaced together under the kind of the first one.
    """
    whole_row = F.struct("*").alias("row")
    keyed = docs.select(
        whole_row,
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.xxhash64(text_or_empty(text_col)).alias("text_key"),
    )
    profiles = store(profile(_documents(docs, id_col, text_col)), "entities")
    rows = _with_added(keyed, profiles)
    text = F.col("text")
    spans = F.array_sort(F.concat(base_spans(text), F.col("added")))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def cut(state: Column, span: Column) -> Column:
        fresh = span["start"] >= state["at"]
        part = F.concat(
            F.substring(text, state["at"] + 1, span["start"] - state["at"]), F.lit("["), F.upper(span["kind"]), F.lit("]")
        )
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(fresh, F.concat(state["out"], F.array(part))).otherwise(state["out"]).alias("out"),
        )

    whole = F.aggregate(
        spans,
        begin,
        cut,
        lambda state: F.concat(F.array_join(state["out"], ""), F.substring(text, state["at"] + 1, F.length(text))),
    )
    clean = F.when(text.isNull() | (F.size(spans) == 0), text).otherwise(whole)
    return rows.withColumn("row", F.col("row").withField(f"`{text_col}`", clean)).select("row.*")
