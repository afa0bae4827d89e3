"""Personal data: patterns, and terms that give a protected value away (DataFrame functions only).

Base finds are e-mail addresses, IPv4 addresses, payment cards and phone numbers, leftmost and without
overlap per kind, by code point.  Each find is a protected value (case and separators aside).

Terms are judged by co-occurrence over the corpus.  A value v known in ``support`` different texts or more is
protected with information content IC(v) = log(D / df(v)).  A term t of such a text (letters only) discloses
v by PMI(v; t) / IC(v), with PMI = log(D * df(v, t) / (df(v) * df(t))): 1 if every document with t holds v.
From ``remove`` on a term is taken out, from ``generalise`` on it is replaced by its class.  df(v) and
df(v, t) count different texts, df(t) and D all documents, so copies of a text never raise a disclosure.
Only texts that hold the value lose terms; a document without personal data is never touched.

Only terms whose df(t) can still reach the threshold meet the values of their text, so long texts with many
values do not list all combinations.

Rows: NULL and empty texts hold nothing; repeated rows get equal results; NULL ids are kept; an empty table
gives no rows.  Extra columns are ignored by ``personal_data`` and kept by ``sanitise``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import Stored

# Each pattern finds what the plain form beside it finds; possessive repeats and the look-behind only spare
# attempts that cannot succeed, so long runs neither recurse nor take quadratic time.
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = tuple(PATTERNS)
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
_TERM = r"(?<!\S)\p{L}++(?=[.,;:!?)]*+(?:\s|$))"
_SPANS = "array<struct<start:int,end:int,hit:string>>"


@dataclass(frozen=True)
class Disclosure:
    """support: different texts a value is known in; generalise, remove: shares of its information content."""

    support: int = 3
    generalise: float = 0.9
    remove: float = 0.999


def _hits(text: Column, kind: str) -> Column:
    """All matches of a kind; texts without the character every match has are not searched."""
    possible = text.contains("@") if kind == "email" else text.contains("+") if kind == "phone" else text.rlike("[0-9]")
    return F.when(possible, F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _valid(hit: Column, kind: str) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]", "")
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return hit.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "phone":
        return F.length(digits).between(9, 15)
    # from the right, every second digit is doubled and its digits are summed
    luhn = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda total, i: total + F.when(
        i % 2 == 1, _digit(digits, i)).otherwise(_digit(digits, i) * 2 - F.when(_digit(digits, i) > 4, 9).otherwise(0)))
    return F.when(F.length(digits).between(13, 19), luhn % 10 == 0).otherwise(False)


def _digit(digits: Column, from_right: Column) -> Column:
    return F.substring(digits, -from_right, F.lit(1)).cast("int")


def _pieces(text: Column, pattern: str, hits: Column) -> Column:
    """(text before the match, match) for every match, in order."""
    return F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits)), hits,
                      lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))


def _spans(pieces: Column, wanted) -> Column:
    """start, end (code points, end exclusive) and text of the wanted matches."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

    def step(done: Column, piece: Column) -> Column:
        begin = done["at"] + F.length(piece["gap"])
        end = begin + F.length(piece["hit"])
        span = F.struct(begin.alias("start"), end.alias("end"), piece["hit"].alias("hit"))
        return F.struct(end.alias("at"), F.when(wanted(piece["hit"]), F.array_append(done["spans"], span)).otherwise(
            done["spans"]).alias("spans"))

    return F.aggregate(pieces, start, step, lambda done: done["spans"])


def _listed(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.concat(F.lit(f"{kind}:"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")))


def _values(spans: Column, kind: str) -> Column:
    """Protected values: one spelling for each."""
    return F.transform(spans, lambda s: F.concat(F.lit(f"{kind}:"), F.lower(s["hit"]) if kind in ("email", "ip")
                                                 else F.regexp_replace(s["hit"], "[^0-9]", "")))


def find(docs: DataFrame) -> DataFrame:
    """doc_id, print (digest of the text), the base finds of each kind, their values; the text only where something was found."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumns({f"hits_{k}": _hits(F.col("text"), k) for k in KINDS})
    none = F.array().cast(_SPANS)
    rows = rows.withColumns({k: F.when(F.size(f"hits_{k}") > 0, _spans(
        _pieces(F.col("text"), PATTERNS[k], F.col(f"hits_{k}")), lambda hit, k=k: _valid(hit, k))).otherwise(none) for k in KINDS})
    found = F.greatest(*[F.size(k) for k in KINDS]) > 0
    return rows.select("doc_id", F.md5(F.col("text").cast("binary")).alias("print"), *KINDS, F.when(found, F.col("text")).alias("text"),
                       F.array_distinct(F.concat(*[_values(F.col(k), k) for k in KINDS])).alias("values"))


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_TERM), F.lit(0))


def disclosing_terms(docs: DataFrame, found: DataFrame, store: Stored, by: Disclosure = Disclosure()) -> DataFrame:
    """print, drop and blur: the terms of a text that are taken out and those that are generalised."""
    texts = found.where("text IS NOT NULL").groupBy("print").agg(F.first("text").alias("text"), F.first("values").alias("values"))
    held = texts.select("print", F.explode("values").alias("value"))
    known = held.groupBy("value").agg(F.count("*").alias("df_v")).where(F.col("df_v") >= by.support)
    holders = store.save(held.join(known, "value"), "holders")
    reach = holders.groupBy("print").agg(F.max("df_v").alias("most"))
    total = F.broadcast(found.agg(F.count("*").cast("double").alias("total")))  # one row

    own = store.save(texts.join(reach, "print").select(
        "print", "most", F.explode(F.array_distinct(F.transform(_terms(F.col("text")), F.lower))).alias("term")), "terms")
    wanted = own.select(F.xxhash64("term").alias("code")).distinct()
    corpus = docs.select(F.explode(F.array_distinct(F.transform(_terms(F.coalesce("text", F.lit(""))), F.lower))).alias("term"))
    seen = corpus.groupBy(F.xxhash64("term").alias("code")).agg(F.count("*").alias("df_t")).join(wanted, "code")
    # PMI / IC = 1 + log(df_vt / df_t) / log(D / df_v): with df_vt at most df_v this bounds df_t
    ratio = 1 + F.log(F.col("df_vt") / F.col("df_t")) / F.log((F.col("total") + 1) / F.col("df_v"))
    near = own.withColumn("code", F.xxhash64("term")).join(seen, "code").crossJoin(total).where(
        1 + F.log(F.col("most") / F.col("df_t")) / F.log((F.col("total") + 1) / F.col("most")) >= by.generalise)
    pairs = near.join(holders, "print").groupBy("value", "term").agg(
        F.count("*").alias("df_vt"), F.first("df_v").alias("df_v"), F.first("df_t").alias("df_t"), F.first("total").alias("total"))
    telling = store.save(pairs.where(F.col("df_vt") >= by.support).withColumn("told", ratio).where(
        F.col("told") >= by.generalise).select("value", "term", "told"), "telling")
    chosen = holders.select("print", "value").join(telling, "value").join(own.select("print", "term"), ["print", "term"]).groupBy(
        "print", "term").agg(F.max("told").alias("told"))
    return store.save(chosen.groupBy("print").agg(
        F.collect_list(F.when(F.col("told") >= by.remove, F.col("term"))).alias("drop"),
        F.collect_list(F.when(F.col("told") < by.remove, F.col("term"))).alias("blur")), "chosen")


def personal_data(docs: DataFrame, by: Disclosure = Disclosure()) -> DataFrame:
    """doc_id, numbers of finds, a digest of the base spans, all spans, and how many terms disclose a value."""
    store = Stored(docs.sparkSession, "pii")
    found = store.save(find(docs), "found")
    rows = found.join(disclosing_terms(docs, found, store, by), "print", "left")
    terms = F.concat("drop", "blur")
    tokens = _terms(F.col("text"))
    rows = rows.withColumn("term", F.when(F.size(terms) > 0, _spans(
        _pieces(F.col("text"), _TERM, tokens), lambda hit: F.array_contains(terms, F.lower(hit)))).otherwise(F.array().cast(_SPANS)))
    base = [_listed(F.col(k), k) for k in KINDS]
    return rows.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.array_join(F.concat(*base), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.concat(*base, _listed(F.col("term"), "term")), ",").alias("spans"),
        F.size("term").cast("long").alias("n_term"))


def sanitise(docs: DataFrame, by: Disclosure = Disclosure()) -> DataFrame:
    """``docs`` with personal data masked and disclosing terms taken out or replaced by [NAME] or [WORD]."""
    store = Stored(docs.sparkSession, "pii")
    found = store.save(find(docs), "found")
    chosen = disclosing_terms(docs, found, store, by)
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text",
                      F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("print"))
    row = row.join(chosen, "print", "left")
    text = F.col("text")
    row = row.withColumns({f"hits_{k}": _hits(text, k) for k in KINDS})
    none = F.array().cast(_PUTS)
    spans = {k: F.when(F.size(f"hits_{k}") > 0, _put(_spans(_pieces(text, PATTERNS[k], F.col(f"hits_{k}")), lambda hit, k=k: _valid(
        hit, k)), rank, lambda hit, k=k: F.lit(f"[{k.upper()}]"))).otherwise(none) for rank, k in enumerate(KINDS)}

    def replaced(hit: Column) -> Column:
        return F.when(F.array_contains("drop", F.lower(hit)), "").when(hit.rlike(r"^\p{Lu}"), "[NAME]").otherwise("[WORD]")

    terms = F.concat("drop", "blur")
    spans["term"] = F.when(F.size(terms) > 0, _put(_spans(_pieces(text, _TERM, _terms(text)), lambda hit: F.array_contains(
        terms, F.lower(hit))), len(KINDS), replaced)).otherwise(none)
    row = row.withColumn("puts", F.array_sort(F.concat(*spans.values())))
    row = row.withColumn("text", F.when(F.size("puts") > 0, _replaced(text, F.col("puts"))).otherwise(text))
    for kind in KINDS:  # what only taking terms out has joined; a projection each, so that no search is repeated
        row = row.withColumn("text", F.when(F.size("drop") > 0, _masked(text, kind)).otherwise(text))
    return row.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


_PUTS = "array<struct<start:int,end:int,rank:int,put:string>>"


def _put(spans: Column, rank: int, put) -> Column:
    """Spans with what is put in their place; of overlapping spans the lowest rank gives it."""
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(rank).alias("rank"),
                                                 put(s["hit"]).alias("put")))


def _replaced(text: Column, puts: Column) -> Column:
    """The text with all spans (in order of their starts) replaced in one pass, overlapping ones as one."""
    start = F.struct(F.lit(0).alias("done"), F.array().cast("array<string>").alias("parts"), F.lit(0).alias("start"),
                     F.lit(0).alias("end"), F.lit(0).alias("rank"), F.lit("").alias("put"))

    def closed(past: Column) -> Column:
        gap = F.substring(text, past["done"] + 1, past["start"] - past["done"])
        return F.array_append(past["parts"], F.concat(gap, past["put"]))

    def step(past: Column, span: Column) -> Column:
        better = span["rank"] < past["rank"]
        joined = F.struct(past["done"].alias("done"), past["parts"].alias("parts"), past["start"].alias("start"),
                          F.greatest(past["end"], span["end"]).alias("end"), F.least(past["rank"], span["rank"]).alias("rank"),
                          F.when(better, span["put"]).otherwise(past["put"]).alias("put"))
        opened = F.struct(past["end"].alias("done"), closed(past).alias("parts"), span["start"].alias("start"),
                          span["end"].alias("end"), span["rank"].alias("rank"), span["put"].alias("put"))
        return F.when(span["start"] < past["end"], joined).otherwise(opened)

    return F.aggregate(puts, start, step, lambda past: F.concat(
        F.array_join(closed(past), ""), F.substring(text, past["end"] + 1, F.length(text))))


def _masked(text: Column, kind: str) -> Column:
    hits = _hits(text, kind)
    return F.when(F.size(hits) > 0, F.array_join(F.zip_with(F.split(text, PATTERNS[kind], -1), hits, lambda gap, hit: F.concat(
        gap, F.when(hit.isNull(), "").when(_valid(hit, kind), F.lit(f"[{kind.upper()}]")).otherwise(hit))), "")).otherwise(text)
