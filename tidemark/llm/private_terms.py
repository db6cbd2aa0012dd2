"""Personal data by pattern, and terms that the corpus ties to it, generalised or removed."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.names import set_aside, unused
from tidemark.llm.shared_files import stored

_LOCAL = "A-Za-z0-9._%+-"
#: Kinds in the order in which spans are listed. A match begins at the first character of its run or where the last
#: one ended, since a match from within the run would also match from its beginning; possessive repeats give the
#: same matches as greedy ones here, as what follows cannot match what they take.
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Blocks of scripts that put no blanks between words: Thai and Lao, Burmese, Khmer, Japanese and Chinese.
_UNSPACED = (
    r"\u0E00-\u0EFF\u1000-\u109F\uAA60-\uAA7F\u1780-\u17FF\u3005-\u3007\u3040-\u30FF\u31F0-\u31FF\u3400-\u4DBF"
    r"\u4E00-\u9FFF\uF900-\uFAFF\uFF66-\uFF9F\x{20000}-\x{3FFFF}"
)
#: A token of letters and digits, with the marks on them. Plain ranges come first, as they are cheaper to test.
TERM = rf"[A-Za-z0-9[\p{{L}}\p{{N}}&&[^{_UNSPACED}]]][A-Za-z0-9[\p{{L}}\p{{N}}\p{{M}}&&[^{_UNSPACED}]]]*+"
UNSPACED = rf"[\p{{L}}\p{{N}}\p{{M}}&&[{_UNSPACED}]]"
#: Runs without blanks have every part of so many characters as a term.
GRAMS = (1, 2, 3, 4)
TERM_KINDS = ("term_removed", "term_generalised")
SPAN = "array<struct<start: int, end: int, found: string>>"


@dataclass(frozen=True)
class Limits:
    """When a term reveals an entity. All shares are of documents.

    disclosure: pointwise mutual information of term and entity over the entity's information content; 1 means
    that the term occurs only with the entity. `generalise` and `remove` are its thresholds; `tied` is the least
    share of the term's documents that hold the entity.

    chance: how many pairs may be taken for tied in the whole corpus though they meet by accident. The documents of a
    term, each of which holds the entity by the entity's share of the corpus, hold it `n_both` times or more with at
    most the Chernoff bound's probability; that, times the number of pairs compared, must not exceed `chance`. Compared
    are the terms and entities that occur in `support` documents at least; two, as one document repeats nothing.
    """

    generalise: float = 0.9
    remove: float = 0.98
    tied: float = 0.5
    support: int = 2
    chance: float = 0.05


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    places = F.sequence(F.lit(0), F.length(digits) - 1)

    def worth(i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, digit * 2 - F.when(digit > 4, 9).otherwise(0)).otherwise(digit)

    return F.aggregate(F.transform(places, worth), F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+(?=.)", "")
        small = lambda p: (F.length(part(p)) <= 3) & (F.substring(part(p), 1, 3).cast("int") <= 255)
        return F.forall(F.split(found, r"\."), small)
    if kind == "card":
        digits = _digits(found)
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(found)).between(8, 15)
    return F.lit(True)


def _spans(text: Column, pattern: str, wanted) -> Column:
    """Spans (code points, end exclusive) of the pattern's matches that `wanted` accepts, in one walk.

    Matches and the gaps between them alternate, so places are sums of lengths; only wanted matches are gathered.
    """
    # Spark splits and extracts with the same matcher, so gap i precedes match i
    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def walk(acc: Column, piece: Column) -> Column:
        begin = acc.at + F.length(piece.gap)
        end = begin + F.coalesce(F.length(piece.found), F.lit(0))
        one = F.struct(begin.alias("start"), end.alias("end"), piece.found.alias("found"))
        taken = F.when(piece.found.isNotNull() & wanted(piece.found), F.concat(acc.spans, F.array(one))).otherwise(acc.spans)
        return F.struct(end.alias("at"), taken.cast(SPAN).alias("spans"))

    return F.aggregate(pieces, start, walk).spans


#: What a text with a match holds at least; cheaper to look for than the matches.
_SIGNS = {"email": "@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]", "card": "[0-9][0-9 -]{15}", "phone": r"\+[0-9]"}


def with_base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the columns email, ip, card and phone: spans of personal data in the whole text (null: none)."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    for kind, pattern in PATTERNS.items():
        spans = _spans(whole, pattern, lambda found, kind=kind: _valid(kind, found))
        docs = docs.withColumn(kind, F.when(whole.rlike(_SIGNS[kind]), spans).otherwise(F.array().cast(SPAN)))
    return docs


def _base(kinds=tuple(PATTERNS)) -> Column:
    return F.concat(*[F.col(kind) for kind in kinds])


def _name(kind: str, found: Column) -> Column:
    """The entity that a span mentions: its kind and normalised value."""
    return F.concat(F.lit(f"{kind}:"), F.lower(found) if kind == "email" else _digits(found))


def _mentions(kind: str) -> Column:
    return F.transform(F.col(kind), lambda s: _name(kind, s.found))


def _grams(run: Column, size: int) -> Column:
    """The parts of a run without blanks, one from each place."""
    return F.regexp_extract_all(run, F.lit(f"(?=({UNSPACED}{{{size}}}))"), F.lit(1))


def _has_unspaced(text: Column) -> Column:
    return text.rlike(r"[^\x00-\u0DFF]") & text.rlike(UNSPACED)


def _terms(text: Column) -> Column:
    """Distinct terms: lower-cased tokens of letters and digits, and all short parts of runs without blanks."""
    low = F.lower(F.coalesce(text, F.lit("")))
    tokens = F.regexp_extract_all(low, F.lit(TERM), F.lit(0))
    parts = F.concat(tokens, *[_grams(low, size) for size in GRAMS])
    return F.array_distinct(F.when(_has_unspaced(low), parts).otherwise(tokens))


def _term_spans(text: Column, wanted) -> Column:
    """Spans of the terms that `wanted` accepts, by start."""

    def parts(run: Column) -> Column:
        place = lambda size: lambda found, i: F.struct(
            (run.start + i).alias("start"), (run.start + i + size).alias("end"), found.alias("found")
        )
        return F.concat(*[F.transform(_grams(run.found, size), place(size)) for size in GRAMS])

    runs = _spans(text, f"{UNSPACED}++", lambda run: F.lit(True))
    unspaced = F.filter(F.flatten(F.transform(runs, parts)), lambda s: wanted(s.found)).cast(SPAN)
    tokens = _spans(text, TERM, wanted)
    return F.when(_has_unspaced(text), F.array_sort(F.concat(tokens, unspaced))).otherwise(tokens)


def _log_accident(both: Column, of: Column, share: Column) -> Column:
    """Log of the Chernoff bound on the chance of `both` or more among `of` draws that each succeed by `share`."""
    rest = of - both
    kept = F.when(rest > 0, rest * F.log(rest / (of * (1 - share)))).otherwise(F.lit(0.0))
    return F.when(both > of * share, -(both * F.log(both / (of * share)) + kept)).otherwise(F.lit(0.0))


def disclosing_terms(docs: DataFrame, limits: Limits) -> DataFrame:
    """(term, entity, disclosure) of the terms that reveal a protected entity, over the whole corpus.

    All frequencies are numbers of documents, wherever in its text a document holds the term: of entities, of terms,
    and of both together. Before terms meet entities, those that cannot pass leave: a term and an entity are together
    in no more documents than hold the entity, or than hold the term and any entity. All are sums that combine on the
    map side, so a common word or entity costs no task more than another.
    """
    documents = docs.count()
    mentions = F.array_distinct(F.concat(*[_mentions(kind) for kind in PATTERNS]))
    holding = with_base_spans(docs.select("text")).where(F.size(_base()) > 0)
    holding = holding.select(mentions.alias("entities"), _terms(F.col("text")).alias("terms"))
    # numbers of rows hold once they are written
    holding = stored(holding.withColumn("document", F.monotonically_increasing_id()), "holding")
    entities = holding.select("document", F.explode("entities").alias("entity"))
    of_entity = entities.groupBy("entity").agg(F.count("*").alias("n_entity")).where(F.col("n_entity") >= limits.support)
    of_entity = stored(of_entity, "entities")
    entities = stored(entities.join(of_entity.select("entity"), "entity", "left_semi"), "mentions")
    terms = holding.join(entities.select("document"), "document", "left_semi")
    terms = stored(terms.select("document", F.explode("terms").alias("term")), "terms")
    most = terms.groupBy("term").agg(F.count("*").alias("most")).where(F.col("most") >= limits.support)
    # words are summed before they meet the candidates, so that no task gets all rows of a common one
    of_term = docs.select(F.explode(_terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    of_term = stored(of_term.where(F.col("n_term") >= limits.support), "frequencies")
    compared = of_term.count() * of_entity.count()
    of_term = of_term.join(most, "term").where(F.col("most") >= limits.tied * F.col("n_term")).select("term", "n_term")
    of_term = stored(of_term, "candidates")
    together = (
        terms.join(of_term.select("term"), "term", "left_semi")
        .join(entities, "document")
        .groupBy("term", "entity")
        .agg(F.count("*").alias("n_both"))
        .where(F.col("n_both") >= limits.support)
    )
    information = F.log(F.lit(float(documents)) / F.col("n_entity"))
    shared = F.log(F.col("n_both") * F.lit(float(documents)) / (F.col("n_term") * F.col("n_entity")))
    accident = _log_accident(F.col("n_both"), F.col("n_term"), F.col("n_entity") / F.lit(float(documents)))
    return (
        together.join(of_entity, "entity")
        .join(of_term, "term")
        .withColumn("disclosure", F.when(information > 0, shared / information).otherwise(F.lit(0.0)))
        .where((F.col("n_both") >= limits.tied * F.col("n_term")) & (F.col("disclosure") >= limits.generalise))
        .where(accident + math.log(max(compared, 1)) <= math.log(limits.chance))
        .select("term", "entity", "disclosure")
    )


def find(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Every row of `docs` with its spans: email, ip, card, phone, term_removed and term_generalised.

    Base spans follow `PATTERNS` (leftmost, not overlapping within a kind; matches that fail their check are
    dropped). Terms whose disclosure of some entity is at least `limits.remove` are to be removed, those from
    `limits.generalise` on to be generalised, wherever they stand outside base spans.

    Frequencies count rows, so copies of a document count as often as they occur: run this behind a
    de-duplication. Null texts are empty. An empty table gives none. Columns of `docs` named like a result
    column are replaced; no other name clashes.
    """
    docs = docs.drop(*PATTERNS, *TERM_KINDS)
    row, *sets = [unused(docs.columns, name) for name in ("_text", "_removed", "_generalised")]
    texts = docs.select(F.col("text").cast("string").alias("text"))
    revealing = stored(
        disclosing_terms(texts, limits).groupBy("term").agg(F.max("disclosure").alias("disclosure")), "revealing"
    )
    # rows meet their terms by the hash of their text; only texts with such a term move
    key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    remove = F.col("disclosure") >= limits.remove
    hits = (
        texts.select(key.alias(row), F.explode(_terms(F.col("text"))).alias("term"))
        .join(revealing, "term")
        .groupBy(row)
        .agg(
            F.collect_set(F.when(remove, F.col("term"))).alias(sets[0]),
            F.collect_set(F.when(~remove, F.col("term"))).alias(sets[1]),
        )
    )
    found = with_base_spans(docs).withColumn(row, key).join(stored(hits, "hits"), row, "left")
    whole = F.coalesce(F.col("text").cast("string"), F.lit(""))
    outside = lambda s: ~F.exists(_base(), lambda b: (b.start < s.end) & (s.start < b.end))
    for name, terms in zip(TERM_KINDS, map(F.col, sets), strict=True):
        spans = _term_spans(whole, lambda word, terms=terms: F.array_contains(terms, F.lower(word)))
        spans = F.when(F.size(terms) > 0, F.filter(spans, outside)).otherwise(F.array().cast(SPAN))
        found = found.withColumn(name, spans)
    return found.drop(row, *sets)


def listed(kinds: tuple[str, ...]) -> Column:
    """kind:start:end of all spans, by kind as given, then start, joined by commas."""
    shown = lambda kind: (lambda s: F.concat_ws(":", F.lit(kind), s.start, s.end))
    return F.array_join(F.concat(*[F.transform(F.col(kind), shown(kind)) for kind in kinds]), ",")


def sanitise(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """`docs` with all spans of `find` replaced in text: base spans by their kind, generalised terms by [term],
    removed terms by nothing. Spans that overlap are replaced as one, by the name of the first. Other columns stay,
    whatever their names.
    """
    docs, back = set_aside(docs, [*PATTERNS, *TERM_KINDS])
    at = unused([*docs.columns, *PATTERNS, *TERM_KINDS], "_spans")
    names = {**{kind: f"[{kind}]" for kind in PATTERNS}, "term_removed": "", "term_generalised": "[term]"}
    text = F.col("text")

    def named(kind: str) -> Column:
        put = F.lit(names[kind]).alias("put")
        return F.transform(F.col(kind), lambda s: F.struct(s.start.alias("start"), s.end.alias("end"), put))

    spans = F.concat(*[named(kind) for kind in names])

    def replace(acc: Column, s: Column) -> Column:
        fresh = F.concat(acc.parts, F.array(F.substring(text, acc.at + 1, s.start - acc.at), s.put))
        return F.struct(
            F.greatest(acc.at, s.end).alias("at"),
            F.when(s.start >= acc.at, fresh).otherwise(acc.parts).cast("array<string>").alias("parts"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    ended = lambda acc: F.concat(F.array_join(acc.parts, ""), F.substring(text, acc.at + 1, F.length(text)))
    clean = F.when(F.size(at) > 0, F.aggregate(at, start, replace, ended)).otherwise(text)
    found = find(docs, limits).withColumn(at, F.array_sort(spans)).withColumn("text", clean)
    return found.select(*back)


def op6_private_terms(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in all documents, with the terms that reveal it."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return find(docs).select(
        "doc_id",
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in PATTERNS],
        F.sha2(listed(tuple(PATTERNS)), 256).alias("base_sha256"),
        listed((*PATTERNS, *TERM_KINDS)).alias("spans"),
    )
