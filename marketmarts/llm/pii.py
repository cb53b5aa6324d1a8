"""Personal data: pattern spans, and terms that give a protected entity away.

Base spans come from four patterns (email, ip, card, phone), leftmost and not
overlapping within a kind.  Their values are the protected entities.  Every
word of a document that mentions an entity is a candidate term.  For entity e
and term t with document counts c(e), c(t), c(e, t), all over whole documents
and all N documents, the information that t gives about e is

    PMI(e; t) = log(c(e, t) N / (c(e) c(t))),    IC(e) = log(N / c(e)),

and disclosure = PMI / IC.  It is 1 if t occurs with e alone.  Every term seen
with an entity is rated, also if both stand in one document only.  From
disclosure ``remove_at`` on it is removed at all its places in the documents
that mention the entity, and generalised from ``generalise_at`` on.

All of it is DataFrame code: one scan of the texts for mentions and the words
of documents that have some, one for term counts.  No text is shuffled, only
the words of entity-bearing documents with their places.  Disclosure of at
least g implies c(t) <= N^(1 - g) c(e)^g; with the largest c(e) this leaves
out common words before words meet entities, and loses none.  Counts are
aggregated on the map side, so a hot entity or word arrives as one row per
task, and joins on hot keys are left to adaptive skew splitting.

The patterns are written with possessive quantifiers and a left boundary.
Neither changes a match (what follows a run can never be part of it, and a
match from inside a run implies one from its start); they keep the matcher
linear and free of deep recursion on very long texts.

Nulls and ties: a null text counts as empty and has no spans; rows that agree
in id and text are one document for the counts and get the same spans; a null
id is an id like any other; an empty table gives an empty result; other
columns are ignored (``sanitise`` carries them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketmarts.llm.common import stored, text_or_empty

REMOVE_AT = 0.98
GENERALISE_AT = 0.9
BLOCK = 64

KINDS = ("email", "ip", "card", "phone", "term")
_LOCAL = "[A-Za-z0-9._%+-]"
_LABEL = "[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Cheap tests that a text must pass to have a match at all.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
#: A word of three or more letters that is no part of an address-like token.
TERM = r"(?<![\p{L}\p{N}@._%+-])\p{L}[\p{L}\p{N}]{2,}+(?![@_%+-]|\.[\p{L}\p{N}@._%+-])"


def _running(lengths: Column) -> Column:
    """Sum of the elements before each one; two levels, so long arrays stay cheap."""
    n = F.size(lengths)
    blocks = F.when(n > 0, F.transform(F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")),
                                       lambda b: F.slice(lengths, b * BLOCK + 1, BLOCK))).otherwise(
        F.array().cast("array<array<int>>"))
    zero = F.lit(0)

    def total(xs: Column) -> Column:
        return F.aggregate(xs, zero, lambda a, x: a + x)

    start = F.struct(zero.alias("sum"), F.array().cast("array<array<int>>").alias("out"))

    def step(acc: Column, xs: Column) -> Column:
        inner = F.transform(xs, lambda _, i: acc["sum"] + total(F.slice(xs, 1, i)))
        return F.struct((acc["sum"] + total(xs)).alias("sum"), F.concat(acc["out"], F.array(inner)).alias("out"))

    return F.flatten(F.aggregate(blocks, start, step)["out"])


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> in code points."""
    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("gaps"))

    def spans(x: Column) -> Column:
        steps = F.transform(x["m"], lambda v, i: F.length(F.get(x["gaps"], i)) + F.length(v))

        def placed(starts: Column) -> Column:
            return F.transform(x["m"], lambda v, i: F.struct(
                (F.get(starts, i) + F.length(F.get(x["gaps"], i))).alias("start"),
                (F.get(starts, i) + F.length(F.get(x["gaps"], i)) + F.length(v)).alias("end"),
                v.alias("value")))

        return F.transform(F.array(_running(steps)), placed)[0]

    # binding by a lambda keeps each pattern to one pass over the text
    return F.transform(F.array(both), spans)[0]


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def worth(i: Column) -> Column:
        v = F.ascii(F.substring(digits, -i, F.lit(1))) - 48
        return F.when(i % 2 == 1, v).otherwise(v * 2 - F.when(v > 4, 9).otherwise(0))

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), worth), F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, v: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return v.rlike(rf"^{part}(?:\.{part}){{3}}$")
    n = F.length(_digits(v))
    if kind == "card":
        return F.when((n >= 12) & (n <= 19), _luhn(_digits(v))).otherwise(False)
    return (n >= 9) & (n <= 15)


def base_spans(text: Column) -> Column:
    """All base spans of a text: array<struct<start, rank, end, kind, value>> by start, then kind."""
    def of(rank: int, kind: str) -> Column:
        may = text.contains(NEEDS[kind]) if NEEDS[kind] else F.lit(True)
        if kind != "email":
            may = may & text.rlike("[0-9]")
        kept = F.filter(matches(text, PATTERNS[kind]), lambda s: _valid(kind, s["value"]))
        return F.when(may, F.transform(kept, lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"),
            (s["value"] if kind in ("email", "ip") else _digits(s["value"])).alias("value"))))

    found = [of(rank, kind) for rank, kind in enumerate(PATTERNS)]
    empty = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"
    return F.array_sort(F.concat(*[F.coalesce(x, F.array().cast(empty)) for x in found]))


def mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, base, words) per row; words: all words with their places, of rows with base spans only."""
    # words are found before they are lower-cased, which may change a text's length
    words = F.transform(matches(F.col("text"), TERM), lambda w: F.struct(
        F.lower(w["value"]).alias("term"), w["start"].alias("start"), w["end"].alias("end")))
    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).select(
        "id", "text", F.xxhash64("text").alias("text_hash"), base_spans(F.col("text")).alias("base")).select(
        "id", "text_hash", "base", F.when(F.size("base") > 0, words).alias("words"))


def _entities(found: DataFrame) -> DataFrame:
    """(id, text_hash, kind, value), once per document and entity."""
    return (found.select("id", "text_hash", F.explode("base").alias("m"))
            .select("id", "text_hash", "m.kind", "m.value").distinct())


def _together(docs: DataFrame, found: DataFrame, entities: DataFrame, n_docs: DataFrame, id_col: str, text_col: str,
              generalise_at: float) -> DataFrame:
    """Terms that may disclose with the entities of their documents: id, text_hash, kind, value, term, places, c_t."""
    of_text = F.regexp_extract_all(text_or_empty(text_col), F.lit(TERM), F.lit(0))
    each = F.explode(F.array_distinct(F.transform(F.array_distinct(of_text), F.lower))).alias("term")
    terms = docs.select(each).groupBy("term").agg(F.count("*").alias("c_t"))
    # a repeated row is one document; only where there are any do their texts meet the list of them
    repeats = stored(found.groupBy("id", "text_hash").agg(F.count("*").alias("times")).filter("times > 1"), "pii-repeats")
    if not repeats.isEmpty():
        again = docs.join(repeats.withColumnsRenamed({"id": "_id", "text_hash": "_hash"}), F.col(id_col).eqNullSafe(F.col("_id")) & (
            F.xxhash64(text_or_empty(text_col)) == F.col("_hash"))).select("_id", "_hash", "times", each)
        more = (again.groupBy("term", "_id", "_hash", "times").agg(F.count("*").alias("_n"))
                .groupBy("term").agg(F.sum(F.col("times") - 1).alias("more")))
        terms = terms.join(more, "term", "left").select("term", (F.col("c_t") - F.coalesce("more", F.lit(0))).alias("c_t"))
    most = entities.groupBy("kind", "value").count().agg(F.max("count").alias("n")).scalar()
    bound = F.pow(n_docs.scalar(), F.lit(1 - generalise_at)) * F.pow(most, F.lit(generalise_at)) * (1 + 1e-9)
    words = (found.filter(F.size("base") > 0).select("id", "text_hash", F.explode("words").alias("w"))
             .groupBy("id", "text_hash", "w.term").agg(F.collect_set(F.struct("w.start", "w.end")).alias("places")))
    rare = words.join(terms.filter(F.col("c_t") <= bound), "term").withColumnsRenamed({"id": "_id", "text_hash": "_hash"})
    return (rare.join(entities, F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")))
            .select("id", "text_hash", "kind", "value", "term", "places", "c_t"))


def disclosing_terms(near: DataFrame, entities: DataFrame, n_docs: DataFrame, remove_at: float = REMOVE_AT,
                     generalise_at: float = GENERALISE_AT) -> DataFrame:
    """(kind, value, term, disclosure, action) of every term above a threshold, from counts over all documents."""
    together = near.groupBy("kind", "value", "term").agg(F.count("*").alias("c_et"), F.max("c_t").alias("c_t"))
    counts = entities.groupBy("kind", "value").agg(F.count("*").alias("c_e"))
    rated = together.join(counts, ["kind", "value"]).withColumn("n_docs", n_docs.scalar())
    info = F.log(F.col("n_docs") / F.col("c_e"))
    rated = (rated.filter("n_docs > c_e").withColumn(
        "disclosure", F.log(F.col("c_et") * F.col("n_docs") / (F.col("c_e") * F.greatest("c_t", "c_et"))) / info)
        .filter(F.col("disclosure") >= generalise_at))
    return rated.select("kind", "value", "term", "disclosure",
                        F.when(F.col("disclosure") >= remove_at, "remove").otherwise("generalise").alias("action"))


def all_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", remove_at: float = REMOVE_AT,
              generalise_at: float = GENERALISE_AT) -> DataFrame:
    """(id, text_hash, base, terms) per row; terms: array<struct<start, rank, end, kind, action>>, clear of base spans."""
    found = stored(mentions(docs, id_col, text_col), "pii-mentions")
    n_docs = found.select(F.countDistinct(F.struct("id", "text_hash")).cast("double").alias("n_docs"))
    entities = _entities(found)
    near = stored(_together(docs, found, entities, n_docs, id_col, text_col, generalise_at), "pii-terms")
    risky = disclosing_terms(near, entities, n_docs, remove_at, generalise_at)
    hits = (near.join(risky, ["kind", "value", "term"]).select("id", "text_hash", F.explode("places").alias("p"), "action")
            .groupBy("id", "text_hash", "p.start", "p.end").agg(F.max("action").alias("action"))  # remove wins over generalise
            .groupBy("id", "text_hash").agg(F.array_sort(F.collect_list(F.struct(
                "start", F.lit(len(PATTERNS)).alias("rank"), "end", F.lit("term").alias("kind"), "action"))).alias("terms")))
    hits = hits.select(F.col("id").alias("_id"), F.col("text_hash").alias("_hash"), "terms")
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,action:string>>")
    return (found.join(hits, F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
            .select("id", "text_hash", "base", F.filter(F.coalesce("terms", empty), lambda t: ~F.exists(
                "base", lambda b: (b["start"] < t["end"]) & (b["end"] > t["start"]))).alias("terms")))


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Counts per kind, the digest of the base spans and all spans of every row."""
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind))

    rows = all_spans(docs, id_col, text_col, **how)
    places = lambda c: F.transform(c, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"),
                                                         s["end"].alias("end"), s["kind"].alias("kind")))
    return rows.select(
        F.col("id").alias(id_col),
        *[count(k).cast("bigint").alias(f"n_{k}") for k in PATTERNS],
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.array_sort(F.concat(places(F.col("base")), places(F.col("terms"))))).alias("spans"),
        F.size("terms").cast("bigint").alias("n_term"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with base spans replaced by their kind, disclosing terms removed or replaced by <WORD>.

    Spans that overlap are replaced as one, by the kind of the first.  Texts
    without spans stay as they are, null included.
    """
    rows = all_spans(docs, id_col, text_col, **how).filter((F.size("base") > 0) | (F.size("terms") > 0))
    tag = lambda s: F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">"))
    cuts = F.array_sort(F.concat(
        F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), tag(s).alias("put"))),
        F.transform("terms", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                F.when(s["action"] == "remove", "").otherwise("<WORD>").alias("put")))))
    merged = F.aggregate(cuts, F.array().cast("array<struct<start:int,end:int,put:string>>"), lambda acc, s: F.when(
        (F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1)["end"] > s["start"]),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
            F.get(acc, F.size(acc) - 1)["start"].alias("start"),
            F.greatest(F.get(acc, F.size(acc) - 1)["end"], s["end"]).alias("end"),
            F.get(acc, F.size(acc) - 1)["put"].alias("put"))))).otherwise(F.concat(acc, F.array(s))))
    rows = rows.select(F.col("id").alias("_id"), F.col("text_hash").alias("_hash"), merged.alias("_cuts")).distinct()
    both = docs.withColumn("_th", F.xxhash64(text_or_empty(text_col))).join(
        rows, F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_th") == F.col("_hash")), "left")
    text = F.col(text_col)
    pieces = F.transform("_cuts", lambda s, i: F.concat(
        F.substring(text, F.when(i > 0, F.get(F.col("_cuts"), i - 1)["end"]).otherwise(0) + 1,
                    s["start"] - F.when(i > 0, F.get(F.col("_cuts"), i - 1)["end"]).otherwise(0)), s["put"]))
    tail = F.substring(text, F.element_at("_cuts", -1)["end"] + 1, F.length(text))
    new = F.when(F.col("_cuts").isNotNull(), F.concat(F.array_join(pieces, ""), tail)).otherwise(text)
    return both.withColumn(text_col, new).select(*docs.columns)
