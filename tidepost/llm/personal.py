"""Personal data by patterns and by bootstrapped contexts, in DataFrame operations alone.

Fixed patterns give the base spans, which are the seeds of their kinds; the seeds of a further kind,
secrets, are long runs of hexadecimal digits or of letters of both cases and digits. The words
around an identifier are its contexts: the two and the three before it, and the one on either side.
Contexts and identifiers form a graph: a context is trusted for a kind by the share of its
identifiers that are known to be of the kind, an identifier by its best context, and the two are
scored in turn. Identifiers that no fixed pattern finds are added where they stand in a trusted
context and have the shape of the kind, and so are secrets, which are no base spans even as seeds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepost.llm.common import cut, text_hash, text_of

KINDS = ("email", "ip", "card", "phone")
SECRET = "secret"

# Fixed by the contract. Quantifiers are possessive where nothing is ever given back, and a match
# starts at the end of the last one or where its run of characters starts, so that long runs are
# read once: neither changes what matches.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What may be an identifier: a word with an @, a run of letters and digits, or digits with at most two
#: marks between them.
CANDIDATE = (
    r"(?<!\S)[^@\s]*+@\S++|(?<![0-9A-Za-z_-])(?=[A-Za-z_-]*+[0-9])(?=[0-9_-]*+[A-Za-z])[0-9A-Za-z_-]{8,}+"
    r"|(?<![0-9A-Za-z])[+(]?[0-9](?:[().\x20-]{0,2}[0-9])++"
)
SECRET_SEED = r"^(?:[0-9A-Fa-f]{32,}|(?=.*[a-z])(?=.*[A-Z])(?=.*[0-9].*[0-9])[0-9A-Za-z_-]{24,})$"
CONTEXTS = {"two": r"(\S{1,32}\s+\S{1,32})\s*$", "three": r"(\S{1,32}\s+\S{1,32}\s+\S{1,32})\s*$"}
WORD_BEFORE, WORD_AFTER = r"(\S{1,32})\s*$", r"^\s*(\S{1,32})"
CONTEXT_CHARS = 80
ROUNDS = 3
LEAST_TRUST = 0.6
LEAST_SUPPORT = 3


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of ``value`` pass the Luhn test."""
    plain = F.reverse(digits(value))

    def add(total: Column, at: Column) -> Column:
        digit = F.substring(plain, at + 1, F.lit(1)).cast("int") * (1 + at % 2)
        return total + digit - F.when(digit > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(0), F.length(plain) - 1), F.lit(0), add) % 10 == 0


def fits(kind: Column, value: Column) -> Column:
    """Whether a match of a fixed pattern passes the rule of its kind."""
    count = F.length(digits(value))
    parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    small = F.forall(parts, lambda p: (F.length(p) <= 3) & (F.lpad(p, 3, "0") <= "255"))
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", small)
        .when(kind == "card", F.when(count.between(14, 19), luhn(value)).otherwise(False))
        .when(kind == "phone", count.between(10, 15))
        .otherwise(False)
    )


def shapes(value: Column) -> Column:
    """The kinds that an identifier outside the fixed patterns may have."""
    count = F.length(digits(value))
    shape = {
        "email": value.contains("@") & (F.length(value) >= 5),
        "ip": value.rlike(r"^[0-9]+(?:\.[0-9]+){3,}$"),
        "card": ~value.contains("@") & ~value.rlike("[A-Za-z]") & count.between(12, 19),
        "phone": ~value.contains("@") & ~value.rlike("[A-Za-z]") & count.between(7, 15),
        SECRET: value.rlike("^[0-9A-Za-z_-]{8,}$") & value.rlike("[0-9]") & value.rlike("[A-Za-z]"),
    }
    return F.array_compact(F.array(*[F.when(test, F.lit(kind)) for kind, test in shape.items()]))


def located(text: Column, kind: str, pattern: str) -> Column:
    """Matches as structs: number, kind, characters since the last match, length, value, before, after.

    ``split`` and ``regexp_extract_all`` see the same matches; ``transform`` over one element binds
    both results, so that each is computed once.
    """
    pair = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values"))

    def rows(both: Column) -> Column:
        def one(value: Column, at: Column) -> Column:
            gap = F.get(both["gaps"], at)
            return F.struct(
                at.alias("number"), F.lit(kind).alias("kind"), F.length(gap).alias("gap"), F.length(value).alias("length"),
                value.alias("value"), F.lower(F.substring(gap, -CONTEXT_CHARS, CONTEXT_CHARS)).alias("before"),
                F.lower(F.substring(F.get(both["gaps"], at + 1), 1, CONTEXT_CHARS)).alias("after"),
            )

        return F.transform(both["values"], one)

    return F.get(F.transform(F.array(pair), rows), F.lit(0))


def matches(docs: DataFrame) -> DataFrame:
    """``doc_id, th, row, kind, start, end, value, before, after`` of all matches and candidates.

    Starts are running sums of lengths within a document's matches of a kind; only documents with
    a digit or an @ are looked at, as each pattern needs one.
    """
    text = text_of()
    rows = docs.where(text.rlike("[0-9@]")).select(
        "doc_id", text_hash().alias("th"), F.monotonically_increasing_id().alias("row"), text.alias("text")
    )
    kinds = [located(F.col("text"), kind, pattern) for kind, pattern in {**PATTERNS, "candidate": CANDIDATE}.items()]
    rows = rows.select("doc_id", "th", "row", F.inline(F.concat(*kinds)))
    upto = F.sum(F.col("gap") + F.col("length")).over(Window.partitionBy("row", "kind").orderBy("number"))
    rows = rows.withColumn("end", upto).withColumn("start", F.col("end") - F.col("length"))
    # A candidate's closing marks are not part of it.
    bare = F.regexp_replace("value", r"[.,;:!?)\]}>\"']+$", "")
    candidate = F.col("kind") == "candidate"
    rows = rows.withColumns(
        {
            "end": F.when(candidate, F.col("start") + F.length(bare)).otherwise(F.col("end")),
            "value": F.when(candidate, bare).otherwise(F.col("value")),
        }
    )
    rows = rows.where(candidate | fits(F.col("kind"), F.col("value")))
    return rows.select("doc_id", "th", "row", "kind", "start", "end", "value", "before", "after").where("end > start")


def occurrences(found: DataFrame) -> DataFrame:
    """Candidates with ``contexts``, ``known`` (the kind of the base span that they overlap, or that of
    secrets for their seeds) and ``kinds`` (the shapes they have)."""
    base = F.col("kind") != "candidate"
    order = Window.partitionBy("row").orderBy("start", F.when(base, 0).otherwise(1))
    before = F.max(F.when(base, F.struct("end", "kind"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    after = F.min(F.when(base, F.struct("start", "kind"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    rows = found.withColumns({"before_base": before, "after_base": after}).where("kind = 'candidate'")
    known = F.when(F.col("before_base.end") > F.col("start"), F.col("before_base.kind")).when(
        F.col("after_base.start") < F.col("end"), F.col("after_base.kind")
    ).when(F.col("value").rlike(SECRET_SEED), SECRET)

    def named(name: str, words: Column, *more: Column) -> Column:
        whole = F.concat_ws(" ", F.lit(name), F.regexp_replace(words, r"\s+", " "), *more)
        return F.when((words != "") & reduce(lambda c, w: c & (w != ""), more, F.lit(True)), whole)

    left, right = F.regexp_extract("before", WORD_BEFORE, 1), F.regexp_extract("after", WORD_AFTER, 1)
    contexts = [named(name, F.regexp_extract("before", pattern, 1)) for name, pattern in CONTEXTS.items()]
    contexts = F.array_compact(F.array(*contexts, named("around", left, right)))
    rows = rows.select(
        "doc_id", "th", "start", "end", F.lower("value").alias("value"), contexts.alias("contexts"),
        known.alias("known"), shapes(F.col("value")).alias("kinds"),
    )
    return rows.where(F.col("known").isNotNull() | (F.size("kinds") > 0))


def trusted_contexts(seen: DataFrame) -> DataFrame:
    """``context, kind, trust`` of contexts with enough support, after scoring the graph in rounds."""
    edges = seen.select(F.explode("contexts").alias("context"), "value", "known")
    edges = edges.groupBy("context", "value").agg(F.max("known").alias("known"))
    edges = cut(edges, "context-graph")
    sizes = edges.groupBy("context").agg(F.count("*").alias("size"))
    seeds = edges.where("known IS NOT NULL").select("value", F.col("known").alias("kind"), F.lit(1.0).alias("score")).distinct()
    scores = seeds
    for step in range(ROUNDS):
        votes = edges.select("context", "value").join(scores, "value").groupBy("context", "kind")
        votes = votes.agg(F.sum("score").alias("votes"), F.count("*").alias("support"))
        contexts = votes.join(sizes, "context").withColumn("trust", F.col("votes") / F.col("size"))
        contexts = contexts.where((F.col("support") >= LEAST_SUPPORT) & (F.col("trust") >= LEAST_TRUST))
        contexts = cut(contexts.select("context", "kind", "trust"), f"contexts-{step}")
        found = edges.where("known IS NULL").select("context", "value").join(contexts, "context")
        found = found.groupBy("value", "kind").agg(F.max("trust").alias("score"))
        scores = seeds.unionByName(found)
    return contexts


def added_spans(seen: DataFrame) -> DataFrame:
    """Identifiers without a base span in trusted contexts: ``doc_id, th, kind, start, end``."""
    contexts = trusted_contexts(seen)
    rows = seen.where(F.col("known").isNull() | (F.col("known") == SECRET))
    rows = rows.select("doc_id", "th", "start", "end", "kinds", F.explode("contexts").alias("context")).join(contexts, "context")
    rows = rows.where(F.array_contains("kinds", F.col("kind")))
    best = F.max_by("kind", F.struct("trust", "kind")).alias("kind")
    return rows.groupBy("doc_id", "th", "start", "end").agg(best)


def listed(spans: Column) -> Column:
    """Spans by start, then kind as listed: ``kind:start:end``, joined by commas."""
    texts = F.transform(
        F.array_sort(spans),
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(texts, ",")


def _of_kind(kind: str):
    return lambda s: s["base"] & (s["kind"] == kind)


def find_personal(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added, n_spans`` per document.

    The counts by kind and the hash are those of base spans; ``spans`` has the added ones too, of which
    ``n_added`` and, together, ``n_spans`` tell the number. Positions
    are code points, ends exclusive. Null and empty texts have no span: counts of 0, the hash of
    the empty string, an empty list. Rows that repeat are rows of their own with equal results;
    null ids stay null. An empty table gives no rows; other columns are not looked at.
    """
    found = cut(matches(docs), "matches")
    seen = cut(occurrences(found), "occurrences")
    base = found.where("kind != 'candidate'").select("doc_id", "th", "kind", "start", "end").distinct()
    spans = base.withColumn("base", F.lit(True)).unionByName(added_spans(seen).withColumn("base", F.lit(False)))
    rank = reduce(lambda c, i: c.when(F.col("kind") == KINDS[i], i), range(len(KINDS)), F).otherwise(len(KINDS))
    span = F.struct(F.col("start"), rank.alias("rank"), F.col("kind"), F.col("end"), F.col("base"))
    marks = cut(spans.groupBy("doc_id", "th").agg(F.collect_list(span).alias("all")), "personal-spans")
    rows = docs.select("doc_id", text_hash().alias("_th"))
    right = marks.select(F.col("doc_id").alias("_id"), "th", "all").hint("merge")
    joined = rows.join(right, rows["doc_id"].eqNullSafe(right["_id"]) & (rows["_th"] == right["th"]), "left")
    joined = joined.withColumn("all", F.coalesce("all", F.array().cast(marks.schema["all"].dataType)))
    base = F.filter("all", lambda s: s["base"])
    counts = [
        F.size(F.filter("all", _of_kind(kind))).cast("bigint").alias(f"n_{kind}")
        for kind in KINDS
    ]
    return joined.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), *counts, F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("all")).alias("spans"), (F.size("all") - F.size(base)).cast("bigint").alias("n_added"),
        F.size("all").cast("bigint").alias("n_spans"),
    )
