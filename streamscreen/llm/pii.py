"""Personal data: patterns with checks, and more of it found from its contexts.

Base spans are the valid matches of four patterns. They are the seeds of a bootstrap: every
identifier-shaped token (one with a digit or "@") is an instance, the words around it are its lexical
patterns, and the graph of distinct (pattern, instance) edges is scored for ``ROUNDS`` rounds. A pattern's confidence
for a kind is the mean score of the instances it extracts; one with enough support and confidence
raises the instances it extracts (noisy or). Instances with a high score, the kind's loose shape and such a
pattern around them become added spans. Base spans always stay.

All of it is DataFrame expressions. The texts are read once; what remains of them is a narrow written
table of spans and contexts. Edges are aggregated before they are joined, so a frequent pattern is a
count, not a group of rows, and scores are joined to edges by shuffle, where Spark splits skewed keys.

The patterns below match what the plain forms match, without their quadratic retries: a run of
characters is taken whole (possessive), and tried again only where the last match ended (``\\G``).

Defined results: a null or empty text has no spans; offsets are code points, ends exclusive; repeated rows
give repeated results; rows of one doc_id with different texts are told apart by their text; empty tables
give empty results; other columns are ignored, and ``redact`` keeps them. Context is at most ``CONTEXT`` code points on
each side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamscreen.llm.common import join_counted
from streamscreen.session import durable

KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be tried at all.
TRIGGERS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
#: Loose shapes that an added span must have.
SHAPES = {
    "email": r"^\S+@\S+$", "ip": r"^[0-9]+(\.[0-9]+){3,}$",
    "card": r"^[0-9](?:[\x20-]?[0-9]){11,18}$", "phone": r"^[\x20().0-9+-]*(?:[0-9][\x20().-]*){7,15}$",
}
#: Phones, grouped cards and other numbers in groups (of two to five digits, perhaps one in parentheses, joined by a
#: space, dot or hyphen) are one token; any other token is a run without spaces.
TOKEN = (r"\+[0-9][\x20().0-9-]+[0-9]|(?<!\S)[0-9](?:[\x20-]?[0-9]){11,18}+(?![^\s.,;:!?)])"
         r"|(?<!\S)(?:\([0-9]{2,5}\)[\x20.-]?)?[0-9]{2,5}(?:[\x20.-][0-9]{2,5}){1,4}+(?![^\s.,;:!?)])"
         r"|(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
CONTEXT = 80
ROUNDS = 3
MIN_SUPPORT, MIN_CONFIDENCE, MIN_SCORE = 5, 0.7, 0.9


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        digit = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 0, digit).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":  # parts of at most 255, whatever their leading zeros
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return found.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    n = F.length(_digits(found))
    if kind == "card":
        return F.when((n >= 12) & (n <= 19), _luhn(_digits(found))).otherwise(False)
    return (n >= 9) & (n <= 15)


def _placed(text: Column, pattern: str, keep, made) -> Column:
    """``made(match, start, gap before, gap after)`` for each match that ``keep`` accepts, in order.

    A text is cut once, not again for each match, and only if there is one: what stands within a lambda is worked out for
    every element.
    """
    blank = F.struct(F.lit("").alias("gap"), F.lit("").alias("match"), F.lit("").alias("after"), F.lit(False).alias("keep"))
    kind = F.filter(F.array(made(blank, F.lit(0))), lambda _: F.lit(False))
    begin = F.struct(F.lit(0).alias("at"), kind.alias("out"))

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.length(p["gap"])
        out = F.when(p["keep"], F.concat(acc["out"], F.array(made(p, start)))).otherwise(acc["out"])
        return F.struct((start + F.length(p["match"])).alias("at"), out.alias("out"))

    def placed(cut: Column) -> Column:
        gaps, found = cut["gaps"], cut["found"]
        parts = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, m: F.struct(g.alias("gap"), m.alias("match")))
        parts = F.zip_with(parts, F.slice(gaps, 2, F.size(found)), lambda p, after: F.struct(
            p["gap"].alias("gap"), p["match"].alias("match"), after.alias("after"), keep(p["match"]).alias("keep")))
        return F.aggregate(parts, begin, step, lambda acc: acc["out"])

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    cut = F.transform(F.filter(F.array(found), lambda f: F.size(f) > 0),
                      lambda f: F.struct(F.split(text, pattern, -1).alias("gaps"), f.alias("found")))
    return F.coalesce(F.get(F.transform(cut, placed), F.lit(0)), kind)


def _span(kind: str, start: Column, end: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.cast("int").alias("end"))


NO_SPANS = "array<struct<start:int,rank:int,end:int>>"


def base_spans(text: Column) -> Column:
    """The valid matches of all kinds as (start, rank of the kind, end), sorted."""
    every = []
    for kind in KINDS:
        spans = _placed(text, PATTERNS[kind], lambda m, k=kind: _valid(k, m),
                        lambda p, start, k=kind: _span(k, start, start + F.length(p["match"])))
        every.append(F.when(text.contains(TRIGGERS[kind]), spans))
    none = F.array().cast(NO_SPANS)
    return F.when(text.rlike("[0-9@]"), F.array_sort(F.concat(*[F.coalesce(s, none) for s in every]))).otherwise(none)


# An opening parenthesis around leading digits belongs to the number.
_TRIM_LEFT, _TRIM_RIGHT = r"^(?:[\"'<\[]|\((?![0-9]{2,5}\)))+", r"[\"')>\].,;:!?]+$"
_CUE = r"^[\p{L}_-]{2,40}[=:][\"']?"


def _tokens(text: Column) -> Column:
    """Identifier-shaped tokens: start, value, and up to three lexical patterns around it."""
    def made(p: Column, start: Column) -> Column:
        cue = F.regexp_extract(p["match"], _CUE, 0)
        lead = F.when(cue != "", cue).otherwise(F.regexp_extract(p["match"], _TRIM_LEFT, 0))
        value = F.regexp_replace(F.substr(p["match"], F.length(lead) + 1), _TRIM_RIGHT, "")
        left = F.lower(F.right(p["gap"], F.lit(CONTEXT)))
        right = F.regexp_extract(F.lower(F.left(p["after"], F.lit(CONTEXT))), r"^\s*(\S+)", 1)
        one, two = F.regexp_extract(left, r"(\S+)\s*$", 1), F.regexp_extract(left, r"(\S+\s+\S+)\s*$", 1)
        patterns = F.array(
            F.when(cue != "", F.concat(F.lit("cue "), F.lower(cue))),
            F.when(two != "", F.concat(F.lit("before "), F.regexp_replace(two, r"\s+", " "))),
            F.when((one != "") & (right != ""), F.concat(F.lit("around "), one, F.lit(" _ "), right)))
        return F.struct((start + F.length(lead)).cast("int").alias("start"), value.alias("value"),
                        F.filter(patterns, lambda x: x.isNotNull()).alias("patterns"))

    return F.when(text.rlike("[0-9@]"), _placed(text, TOKEN, lambda m: F.lit(True), made))


def _row_key(text: Column, doc_id: Column) -> Column:
    """Tells rows of one doc_id apart; equal rows share it."""
    return F.xxhash64(doc_id, text)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, _row, base (spans) and tokens of every document: the one pass over the texts, written."""
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = text.select("doc_id", _row_key(F.col("text"), F.col("doc_id")).alias("_row"),
                       base_spans(F.col("text")).alias("base"), _tokens(F.col("text")).alias("tokens"))
    return durable(rows, "pii-scan")


def _occurrences(scanned: DataFrame) -> DataFrame:
    """One row for each token: where, its value, its patterns, and the rank of a base span it overlaps."""
    rows = scanned.where(F.size("tokens") > 0).select("doc_id", "_row", "base", F.explode("tokens").alias("t"))
    end = F.col("t.start") + F.length("t.value")
    over = F.filter("base", lambda s: (s["start"] < end) & (s["end"] > F.col("t.start")))
    return rows.where(F.col("t.value") != "").select(
        "doc_id", "_row", F.col("t.start").alias("start"), end.alias("end"), F.col("t.value").alias("value"),
        F.col("t.patterns").alias("patterns"), F.get(over, F.lit(0))["rank"].alias("seed"))


def discover(scanned: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Added spans: doc_id, _row, start, rank, end."""
    seen = _occurrences(scanned)
    seeds = [F.max(F.when(F.col("seed") == k, 1.0).otherwise(0.0)).alias(f"seed{k}") for k in range(len(KINDS))]
    instances = seen.groupBy("value").agg(*seeds)
    edges = seen.select("value", F.explode("patterns").alias("pattern")).distinct()
    # A pattern that meets too few instances can never have support: it leaves the graph at once.
    wide = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= MIN_SUPPORT).drop("_n")
    edges = durable(edges.join(wide, "pattern"), "pii-edges")
    start = [f"seed{k}" for k in range(len(KINDS))]
    scores = durable(instances.select("value", *start, *[F.col(s).alias(f"score{k}") for k, s in enumerate(start)]),
                     "pii-instances")
    trusted = None
    for _ in range(rounds):
        met = edges.join(scores, "value")
        good = met.groupBy("pattern").agg(*[
            F.when(F.sum(F.when(F.col(f"score{k}") >= MIN_SCORE, 1).otherwise(0)) >= MIN_SUPPORT,
                   F.avg(f"score{k}")).alias(f"conf{k}") for k in range(len(KINDS))])
        sure = [F.when(F.col(f"conf{k}") >= MIN_CONFIDENCE, F.col(f"conf{k}")).alias(f"conf{k}") for k in range(len(KINDS))]
        trusted = durable(good.select("pattern", *sure).where(
            F.coalesce(*[F.col(f"conf{k}") for k in range(len(KINDS))]).isNotNull()), "pii-patterns")
        raised = edges.join(trusted, "pattern").groupBy("value").agg(*[
            F.sum(F.log1p(-F.least(F.coalesce(F.col(f"conf{k}"), F.lit(0.0)), F.lit(0.999999)))).alias(f"_log{k}")
            for k in range(len(KINDS))])
        scores = durable(scores.join(raised, "value", "left").select("value", *start, *[
            F.greatest(F.col(f"seed{k}"), 1 - F.exp(F.coalesce(F.col(f"_log{k}"), F.lit(0.0)))).alias(f"score{k}")
            for k in range(len(KINDS))]), "pii-instances")
    # Instances that no base pattern matches, with a high score for a kind whose shape they have.
    rank = F.coalesce(*[F.when((F.col(f"score{k}") >= MIN_SCORE) & F.col("value").rlike(SHAPES[kind]), F.lit(k))
                        for k, kind in enumerate(KINDS)])
    unseen = scores.where(F.greatest(*start) == 0).select("value", rank.alias("rank")).where(F.col("rank").isNotNull())
    places = seen.where(F.col("seed").isNull()).join(unseen, "value").select(
        "doc_id", "_row", "start", "end", "rank", F.explode("patterns").alias("pattern")).join(trusted, "pattern")
    here = F.coalesce(*[F.when((F.col("rank") == k) & F.col(f"conf{k}").isNotNull(), F.lit(True))
                        for k in range(len(KINDS))], F.lit(False))
    return places.where(here).select("doc_id", "_row", "start", "rank", "end").distinct()


def _added(scanned: DataFrame, rounds: int) -> DataFrame:
    span = F.struct("start", "rank", "end")
    return durable(discover(scanned, rounds).groupBy("doc_id", "_row").agg(F.collect_set(span).alias("_added"))
                   .withColumnsRenamed({"doc_id": "_id", "_row": "_key"}), "pii-added")


def _same_row(row: str) -> Column:
    return F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col(row) == F.col("_key"))


def _all_spans(base: str) -> Column:
    return F.array_sort(F.array_union(F.col(base), F.coalesce(F.col("_added"), F.array().cast(NO_SPANS))))


def find(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, base and spans (base and added), each an array of (start, rank, end) sorted by start and kind."""
    scanned = scan(docs)
    return join_counted(scanned.drop("tokens"), _added(scanned, rounds), _same_row("_row"), "left").select(
        "doc_id", "base", _all_spans("base").alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))))


def redact(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; n_chars, if there is one, follows the text."""
    added = _added(scan(docs), rounds)
    rows = docs.withColumn("_text", F.coalesce("text", F.lit(""))).withColumn(
        "_row", _row_key(F.col("_text"), F.col("doc_id"))).withColumn("_base", base_spans(F.col("_text")))
    spans = join_counted(rows, added, _same_row("_row"), "left").withColumn("_spans", _all_spans("_base"))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        piece = F.concat(F.substr(F.col("_text"), acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0))),
                         F.get(names, s["rank"]))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(fresh, F.concat(acc["out"], F.array(piece))).otherwise(acc["out"]).alias("out"))

    text = F.when(F.size("_spans") == 0, F.col("text")).otherwise(F.aggregate(
        "_spans", begin, step,
        lambda acc: F.concat(F.concat_ws("", acc["out"]), F.substr(F.col("_text"), acc["at"] + 1))))
    out = spans.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.size("_spans") == 0, F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return out.select(*docs.columns)
