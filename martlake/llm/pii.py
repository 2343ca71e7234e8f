"""Personal data: fixed patterns, and terms that disclose a protected entity.

Base spans are e-mail addresses, IP addresses, card numbers and phone numbers.  Each one found is a protected entity
(its kind and normal form).  A term is a word of three letters or more anywhere in a text that holds the entity.
Document counts over the whole corpus estimate how strongly the term t reveals the entity e: their pointwise mutual
information as a share of the information in e,

    log(n(t and e) * N / (n(t) * n(e))) / log(N / n(e)),

which is 1 if t stands only where e stands.  A text with entities counts once, however many copies it has; of other
texts every row counts.  A term discloses the entity if

* the share still is ``GENERALISE`` with Wilson's lower bound of n(t and e) / n(t), at ``Z`` standard deviations, in
  place of the plain one, and
* chance doesn't explain it: of the W words of the corpus that stand in n(t) texts, at most ``CHANCE`` are expected to
  stand in n(t and e) texts of e by chance, W * C(n(t), k) * (n(e) / N) ** k for k = n(t and e) (the binomial by its
  entropy bound).

So a word that stands in one text only is a term where such words are rare, and is none where every text brings some of
its own; a word that comes back with the entity is one.  Every occurrence of a disclosing term in a text that holds the
entity becomes a span (kind ``term``).  Sanitised texts have a base span replaced by its kind; a term by nothing if
its plain share is ``REMOVE`` or more, and else by the class of its form: ``[NAME]`` (a capital and small letters),
``[CODE]`` (capitals) or ``[TERM]``.  Spans that overlap are replaced as one, from the first start to the greatest end.

Only DataFrame functions are used.  The patterns never go back over a run of characters twice, so long runs cost
linear time: a match of the plain pattern starts where such a run starts, or where the match before it ended.

Defined results: a null text is empty; offsets are code points; rows without id and repeated rows are rows of their
own; other columns pass through; an empty table gives no rows.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake.llm.common import whole_text, written

#: Fixed patterns; a run is taken whole and once.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # the plain pattern's matches are whole runs of digits with single separators; these have 13 to 19 digits
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TERM = r"(?<![\p{L}\p{N}_.%+@-])\p{L}{3,}+(?![\p{N}_]|[A-Za-z0-9._%+-]*+@)"
WORD = r"\p{L}{3,}+"
GENERALISE, REMOVE, Z, CHANCE = 0.9, 0.97, 1.0, 0.05


def _let(value: Column, body) -> Column:
    """body(value), with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _found(text: Column, pattern: Column) -> Column:
    """Matches in order: start, end, match."""
    kind = "array<struct<start:int,end:int,match:string>>"

    def steps(parts: Column) -> Column:
        rows = F.arrays_zip(F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"), parts.alias("before"))

        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + F.length(x["before"])
            end = start + F.coalesce(F.length(x["match"]), F.lit(0))
            row = F.struct(start.alias("start"), end.alias("end"), x["match"].alias("match"))
            out = F.when(x["match"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(row)))
            return F.struct(end.alias("at"), out.alias("out"))

        start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))
        return F.aggregate(rows, start, step, lambda acc: acc["out"])

    return F.when(F.rlike(text, pattern), _let(F.split(text, pattern, -1), steps)).otherwise(F.array().cast(kind))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        part = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return match.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        return F.call_function("luhn_check", _digits(match))
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def _entity(kind: str, match: Column) -> Column:
    name = _digits(match) if kind in ("card", "phone") else F.lower(match)
    return F.concat(F.lit(f"{kind}:"), name)


def _spans(kind: str) -> Column:
    return F.transform(kind, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))


def _kept(kind: str, spans: Column) -> Column:
    return F.filter(spans, lambda x: _valid(kind, x["match"]))


def _entities(kind: str) -> Column:
    return F.transform(kind, lambda x: _entity(kind, x["match"]))


def _lower(words: Column) -> Column:
    return F.array_distinct(F.transform(F.array_distinct(words), F.lower))


def _base(docs: DataFrame) -> DataFrame:
    """The id columns of ``docs``, the text's key, base spans by kind and entities; where there are any, the text."""
    rows = docs.withColumn("text", whole_text())
    for kind, pattern in PATTERNS.items():
        rows = rows.withColumn(kind, _kept(kind, _found(F.col("text"), F.lit(pattern))))
    entities = F.array_distinct(F.concat(*[_entities(k) for k in PATTERNS]))
    return rows.select("doc_id", F.md5("text").alias("key"), *[_spans(k).alias(k) for k in PATTERNS],
                       entities.alias("entities"), F.when(F.size(entities) > 0, F.col("text")).alias("text"))


def _low(both: Column, n: Column) -> Column:
    """Wilson's lower bound of both / n."""
    p, z2 = both / n, Z * Z
    return (p + z2 / (2 * n) - Z * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))) / (1 + z2 / n)


def _disclosing(docs: DataFrame, held: DataFrame, n: int) -> DataFrame:
    """key, term, share: the terms of each text that disclose an entity in it, of n texts."""
    entity = written(held.select(F.explode("entities").alias("entity")).groupBy("entity").agg(
        F.count("*").alias("n_entity")).where(F.col("n_entity") < n), "pii-entities")
    most = entity.agg(F.max("n_entity")).first()[0] or 0
    terms = held.select("key", "copies", F.explode(_lower(F.col("forms"))).alias("term"))
    again = terms.groupBy("term").agg(F.sum(F.col("copies") - 1).alias("again"))
    words = _lower(F.regexp_extract_all(whole_text(), F.lit(WORD), F.lit(0)))
    rows = written(docs.select(F.explode(words).alias("term")).groupBy("term").agg(F.count("*").alias("n_rows")), "pii-words")
    # n(t and e) <= n(e): terms of more texts than this can't reach the bound with any entity
    limit = 1.0001 * most ** GENERALISE * n ** (1 - GENERALISE)
    rare = again.join(rows, "term").select("term", (F.col("n_rows") - F.col("again")).alias("n_term")).where(
        F.col("n_term") <= limit)
    pairs = written(terms.select("key", "term").join(rare, "term").join(
        held.select("key", F.explode("entities").alias("entity")), "key"), "pii-pairs")
    both = pairs.groupBy("entity", "term").agg(F.count("*").alias("both"), F.first("n_term").alias("n_term"))
    # the numbers of texts that words stand in: d different ones need d * d / 2 word occurrences, so they are few
    alike = rows.groupBy(F.col("n_rows").alias("n_term")).agg(F.count("*").alias("alike"))
    whole = F.log(F.lit(n) / F.col("n_entity"))
    share, low = (1 + F.log(p) / whole for p in (F.col("both") / F.col("n_term"), _low(F.col("both"), F.col("n_term"))))
    p, rest = F.col("both") / F.col("n_term"), 1 - F.col("both") / F.col("n_term")
    ways = F.col("n_term") * -(p * F.log(p) + F.when(rest > 0, rest * F.log(rest)).otherwise(0))
    by_chance = F.log(F.coalesce("alike", F.lit(1))) + ways - F.col("both") * whole <= math.log(CHANCE)
    found = (both.join(entity, "entity").where(low >= GENERALISE).join(F.broadcast(alike), "n_term", "left").where(by_chance)
             .select("entity", "term", share.alias("share")))
    return pairs.join(found, ["entity", "term"]).groupBy("key", "term").agg(F.max("share").alias("share"))


def find(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Base spans of every row of ``docs`` (doc_id, text), and term spans (start, end, share, form) of texts by key."""
    docs = docs.select("doc_id", "text")
    base = written(_base(docs), "pii-base")
    held = written(base.where(F.size("entities") > 0).groupBy("key").agg(
        F.count("*").alias("copies"), F.first("entities").alias("entities"), F.first("text").alias("text")).withColumn(
        "forms", F.array_distinct(F.regexp_extract_all("text", F.lit(TERM), F.lit(0)))), "pii-held")
    n = base.count() - (held.agg(F.sum(F.col("copies") - 1)).first()[0] or 0)
    shares = _disclosing(docs, held, n).groupBy("key").agg(
        F.map_from_entries(F.collect_list(F.struct("term", "share"))).alias("shares"))
    # whole words again, of the disclosing ones only
    named = F.filter("forms", lambda f: F.map_contains_key("shares", F.lower(f)))
    start, end = TERM.split(WORD)
    pattern = F.concat(F.lit(f"{start}(?:"), F.array_join(named, "|"), F.lit(rf")(?!\p{{L}}){end}"))
    at = F.transform(_found(F.col("text"), F.col("pattern")), lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), F.col("shares")[F.lower(m["match"])].alias("share"),
        F.when(m["match"].rlike(r"^\p{Lu}\p{Ll}+$"), "[NAME]").when(m["match"].rlike(r"^\p{Lu}+$"), "[CODE]")
        .otherwise("[TERM]").alias("form")))
    by_text = held.join(shares, "key").withColumn("pattern", pattern).select("key", at.alias("term"))
    return base, written(by_text, "pii-spans")


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, a column of spans for each kind, and ``term``."""
    base, terms = find(docs)
    return base.join(terms, "key", "left").select("doc_id", *PATTERNS, F.coalesce("term", F.array().cast(
        "array<struct<start:int,end:int,share:double,form:string>>")).alias("term"))


def joined(*kinds: str) -> Column:
    """kind:start:end of all spans, by kind and start."""
    def names(k: str) -> Column:
        return F.transform(k, lambda x: F.concat(F.lit(f"{k}:"), x["start"].cast("string"), F.lit(":"),
                                                 x["end"].cast("string")))

    return F.concat_ws(",", F.concat(*[names(k) for k in kinds]))


def _replaced(text: Column, found: Column) -> Column:
    """The text with its spans replaced; overlapping ones are one span, named by the first and then the longest."""
    kind = "struct<at:int,out:string>"

    def step(acc: Column, x: Column) -> Column:
        kept = F.substring(text, acc["at"] + 1, x["start"] - acc["at"])
        joined_on = F.struct(F.greatest(acc["at"], x["end"]).alias("at"), acc["out"].alias("out")).cast(kind)
        return F.when(x["start"] < acc["at"], joined_on).otherwise(
            F.struct(x["end"].alias("at"), F.concat(acc["out"], kept, x["by"]).alias("out")).cast(kind))

    def end(acc: Column) -> Column:
        return F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))

    return F.aggregate(F.array_sort(found), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")).cast(kind), step, end)


def sanitise(docs: DataFrame) -> DataFrame:
    """The documents, their columns as they were, with all spans replaced in the text."""
    base, terms = find(docs)

    def marked(k: str) -> Column:
        by = F.lit(f"[{k.upper()}]")
        return F.transform(k, lambda x: F.struct(
            x["start"].alias("start"), (-x["end"]).alias("first"), x["end"].alias("end"),
            (F.when(x["share"] >= REMOVE, "").otherwise(x["form"]) if k == "term" else by).alias("by")))

    none = F.array().cast("array<struct<start:int,first:int,end:int,by:string>>")
    per_text = base.where(reduce(lambda a, b: a | b, [F.size(k) > 0 for k in PATTERNS])).dropDuplicates(["key"])
    marks = per_text.join(terms, "key", "left").select("key", F.concat(
        *[marked(k) for k in PATTERNS], F.coalesce(marked("term"), none)).alias("marks"))
    rest = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*rest).alias("row"), "text", F.md5(whole_text()).alias("key"))
    # marks grow with the corpus: a shuffle join at every size
    out = rows.join(written(marks, "pii-marks").hint("merge"), "key", "left").select("row", F.when(
        F.col("marks").isNotNull(), _replaced(F.col("text"), F.col("marks"))).otherwise(F.col("text")).alias("text"))
    return out.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
