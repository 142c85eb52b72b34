"""Personal data: fixed patterns, and terms that give protected values away.

The patterns find e-mail addresses, network addresses, card and phone numbers. Protected entities are
each value found, what values share (the owner and the domain of an address, networks, the first
digits of numbers), and the classes of data themselves. How strongly a term reveals an entity is estimated from the corpus: the pointwise
mutual information of entity and term, counted per document over whole texts, however far apart they
stand, against the information that the entity itself carries. Words inside of values are no terms. PMI(c;t) = log2(p(c,t) / (p(c) p(t))) and IC(c) = -log2 p(c), with the shares of documents as
probabilities. A term with PMI >= ``GENERALISE`` * IC is replaced by a general word in the documents
that hold the entity, one with PMI >= ``REMOVE`` * IC is taken out. A pair must be seen in at least
``SUPPORT`` different texts, for what values share and for classes in ``LEVEL_SUPPORT``: a word met
once says nothing about its neighbour. A document with the
term alone keeps it: without the entity there is nothing that it could give away.

Everything is made of built-in expressions, joins and aggregates. Patterns are written so that the
pattern engine needs linear time and no recursion on texts of any length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opdiag.llm.quality_rules import let
from opdiag.operators.sized import join_lookup
from opdiag.session import scratch_path

# Fixed patterns. A match starts where its run of characters does, or where the last match ended;
# any other start would fail at the same place, so the pattern does not try it.
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
PATTERNS = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE)))

SUPPORT = 2
#: Texts in which a term must stand with a class of data, or with what values share.
LEVEL_SUPPORT = 5
CLASS = "class:"
GENERALISE = 0.8
REMOVE = 0.95
#: Every word is a term, with its combining marks; support and PMI decide.
TERM = r"[\p{L}\p{N}][\p{L}\p{M}\p{N}]*+"

_HASH, _PLACES, _TERMS = "__pii_text_hash", "__pii_places", "__pii_terms"


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda total, value: total + value)


def _before(lengths: Column) -> Column:
    """For each element the sum of those before it, in blocks of about the root of their number."""

    def by_block(values: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(values).cast("double"))).cast("int")
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(values) - 1) / width).cast("int")),
            lambda at: _sum(F.slice(values, at * width + 1, width)),
        )
        return let(blocks, lambda sums: let(
            F.transform(sums, lambda _, at: _sum(F.slice(sums, F.lit(1), at))),
            lambda starts: F.transform(values, lambda _, at: (
                F.get(starts, F.floor(at / width).cast("int"))
                + _sum(F.slice(values, F.floor(at / width).cast("int") * width + 1, at % width))
            )),
        ))

    return F.when(F.size(lengths) == 0, F.array().cast("array<bigint>")).otherwise(
        let(lengths, by_block)
    )


def _places(text: Column, pattern: Column) -> Column:
    """Matches with ``start``, ``end`` (code points, end exclusive) and ``value``."""

    def located(both: Column) -> Column:
        values, gaps = both["values"], both["gaps"]
        lengths = F.transform(
            values, lambda value, at: (F.length(F.get(gaps, at)) + F.length(value)).cast("long")
        )
        return let(_before(lengths), lambda before: F.transform(values, lambda value, at: let(
            F.get(before, at) + F.length(F.get(gaps, at)),
            lambda start: F.struct(
                start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"),
            ),
        )))

    return let(
        F.struct(
            F.regexp_extract_all(text, pattern, F.lit(0)).alias("values"),
            F.split(text, pattern, -1).alias("gaps"),
        ),
        located,
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    places = F.sequence(F.lit(1), F.length(digits))

    def worth(at: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - at + 1, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return F.when(at % 2 == 0, doubled).otherwise(digit).cast("long")

    return _sum(F.transform(places, worth)) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(
            F.split(value, r"\."),
            lambda part: let(
                F.regexp_replace(part, "^0+", ""),
                lambda bare: (F.length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(0)) <= 255),
            ),
        )
    if kind == "card":
        return let(_digits(value), lambda digits: F.length(digits).between(13, 19) & _luhn(digits))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


#: Cheap tests that a text can hold a value of the kind at all.
def _possible(kind: str, text: Column) -> Column:
    return {
        "email": F.contains(text, F.lit("@")),
        "ip": text.rlike(r"[0-9]\.[0-9]"),
        "card": text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"),
        "phone": F.contains(text, F.lit("+")),
    }[kind]


_PLACE = "array<struct<start:bigint,end:bigint,value:string>>"


def base_places(text: Column) -> Column:
    """Struct with the valid places of each kind, leftmost first; null texts have none."""
    whole = F.coalesce(text, F.lit(""))

    def of(kind: str) -> Column:
        found = F.filter(
            _places(whole, F.lit(PATTERNS[kind])), lambda place: _valid(kind, place["value"])
        )
        return F.when(_possible(kind, whole), found.cast(_PLACE)).otherwise(F.array().cast(_PLACE))

    return F.struct(*[of(kind).alias(kind) for kind in KINDS])


def _named(kind: str, places: Column) -> Column:
    return F.transform(
        places,
        lambda place: F.concat(F.lit(kind + ":"), place["start"], F.lit(":"), place["end"]),
    )


def _entity(kind: str, value: Column) -> Column:
    plain = value if kind == "ip" else F.lower(value) if kind == "email" else _digits(value)
    return F.concat(F.lit(kind + ":"), plain)


def _levels(kind: str, value: Column) -> list[Column]:
    """What a value belongs to: parts that other values share, and the class of data itself."""
    digits = _digits(value)
    parts = {
        "email": [("owner", F.substring_index(F.lower(value), "@", 1)),
                  ("domain", F.substring_index(F.lower(value), "@", -1))],
        "ip": [("network", F.substring_index(value, ".", 3)), ("network", F.substring_index(value, ".", 2))],
        "card": [("issuer", F.left(digits, F.lit(6)))],
        "phone": [("area", F.left(digits, F.lit(5)))],
    }[kind]
    return [
        *(F.concat(F.lit(f"{name}:"), part) for name, part in parts), F.lit(CLASS + kind)
    ]


def _masked(kind: str, text: Column) -> Column:
    """The text with a line end in place of each valid value of the kind."""
    pattern = F.lit(PATTERNS[kind])
    masked = let(F.regexp_extract_all(text, pattern, F.lit(0)), lambda values: F.array_join(
        F.transform(F.split(text, pattern, -1), lambda gap, at: F.concat(gap, F.when(
            at >= F.size(values), ""
        ).when(_valid(kind, F.get(values, at)), "\n").otherwise(F.get(values, at)))), "",
    ))
    return F.when(_possible(kind, text), masked).otherwise(text)


def _with_words(rows: DataFrame, text_col: str) -> DataFrame:
    """``rows`` with the distinct terms of their texts, in lower case, in place of the texts.

    What only stands inside of values is no term. One column per kind, as nested functions take the
    analyzer a multiple of the time per level.
    """
    rows = rows.withColumn(text_col, F.coalesce(F.col(text_col), F.lit("")))
    for kind in KINDS:
        rows = rows.withColumn(text_col, _masked(kind, F.col(text_col)))
    words = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(TERM), F.lit(0))
    return rows.withColumn("words", F.array_distinct(words)).drop(text_col)


def _entities(places: Column) -> Column:
    """Distinct entities of one text."""

    def of(kind: str) -> Column:
        named = F.transform(places[kind], lambda place: F.array(
            _entity(kind, place["value"]), *_levels(kind, place["value"])
        ))
        return F.flatten(named)

    return F.array_distinct(F.concat(*[of(kind) for kind in KINDS]))


def _support(entity: Column) -> Column:
    """Texts that a statement about an entity needs; a value is its own kind of entity."""
    exact = entity.rlike("^(" + "|".join(KINDS) + "):")
    return F.when(exact, SUPPORT).otherwise(LEVEL_SUPPORT)


def _stored(frame: DataFrame, name: str) -> DataFrame:
    """Writes a frame to the shared folder and reads it back."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _holding(docs: DataFrame, text_col: str) -> DataFrame:
    """Rows that hold a value, with their base places; most documents hold none."""
    places = docs.withColumn(_PLACES, base_places(F.col(text_col)))
    return places.filter(_held(F.col(_PLACES))).withColumn(_HASH, F.xxhash64(text_col))


def _held(places: Column) -> Column:
    return sum((F.size(places[kind]) for kind in KINDS), F.lit(0)) > 0


def entity_terms(docs: DataFrame, text_col: str) -> DataFrame:
    """``text_hash, rows, entity, term, with_entity, with_term``: what stands in one text.

    One row per different text, entity and term of it, wherever in the text they stand; ``rows`` is
    the number of documents with the text, ``with_entity`` and ``with_term`` are the documents with
    the one and the other. Left out are pairs that cannot exceed the threshold whatever their
    number: entities of too little support, terms of less than ``SUPPORT`` documents, and, as a PMI
    is at most log2(total / with_term), terms of more than
    total * (with_entity / total) ** ``GENERALISE`` documents.
    """
    return _pairs(*_held_and_terms(docs, text_col, _holding(docs.select(text_col), text_col)))


def _pairs(held: DataFrame, terms: DataFrame) -> DataFrame:
    return held.join(terms, "text_hash").filter("with_term <= most").select(
        "text_hash", "rows", "entity", "term", "with_entity", "with_term"
    )


def _held_and_terms(
    docs: DataFrame, text_col: str, holding: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Supported entities and possible terms of every different text, each written once."""
    text = F.col(text_col)
    found = (
        holding.select(F.col(_HASH).alias("text_hash"), text.alias("text"),
                       _entities(F.col(_PLACES)).alias("entities"))
        .groupBy("text_hash")
        .agg(F.count(F.lit(1)).alias("rows"), F.first("entities").alias("entities"),
             F.first("text").alias("text"))
    )
    found = _stored(_with_words(found, "text"), "holding")
    held = found.select("text_hash", "rows", F.explode("entities").alias("entity"))
    total = docs.agg(F.count(F.lit(1)).alias("total")).scalar()
    supported = (
        held.groupBy("entity")
        .agg(F.sum("rows").alias("with_entity"), F.count(F.lit(1)).alias("texts"))
        .filter(F.col("texts") >= _support(F.col("entity"))).drop("texts")
        .withColumn("most", (1 + 1e-6) * total * F.pow(F.col("with_entity") / total, F.lit(GENERALISE)))
    )
    held = _stored(join_lookup(held, supported, ["entity"]), "held")
    widest = held.groupBy("text_hash").agg(F.max("most").alias("widest"))
    terms = (
        found.select("text_hash", "words").join(widest, "text_hash")
        .select("text_hash", "widest", F.explode("words").alias("term"))
    )
    with_term = (
        _with_words(docs.select(text.alias("text")), "text").select(F.explode("words").alias("term"))
        .groupBy("term").agg(F.count(F.lit(1)).alias("with_term"))
        .filter(F.col("with_term") >= SUPPORT)
    )
    terms = join_lookup(terms, with_term, ["term"]).filter("with_term <= widest").drop("widest")
    return held, _stored(terms, "terms-of-texts")


def disclosing_terms(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """``entity, term, remove``: terms in the texts of an entity that exceed the threshold.

    ``pairs`` is made by ``entity_terms``. All counts are of documents, copies included, and of
    whole texts; the support is of different texts.
    """
    joined = pairs.groupBy("entity", "term").agg(
        F.sum("rows").alias("both"), F.count(F.lit(1)).alias("texts"),
        F.first("with_entity").alias("with_entity"), F.first("with_term").alias("with_term"),
    ).filter(F.col("texts") >= _support(F.col("entity")))
    joined = joined.withColumn("total", docs.agg(F.count(F.lit(1)).alias("total")).scalar())
    pmi = F.log2(F.col("both") * F.col("total") / (F.col("with_entity") * F.col("with_term")))
    information = F.log2(F.col("total") / F.col("with_entity"))
    share = pmi - GENERALISE * information
    return joined.filter((pmi > 0) & (share >= -1e-9)).select(
        "entity", "term", (pmi >= REMOVE * information - 1e-9).alias("remove")
    )


def _with_findings(docs: DataFrame, text_col: str, carried: list[Column | str]) -> DataFrame:
    """Rows that hold a value: ``carried``, base places, and the terms that each text must lose.

    Only these rows are written and joined: a text without a value cannot have terms.
    """
    holding = _stored(_holding(docs.select(*carried), text_col), "holding-rows")
    held, words = _held_and_terms(docs, text_col, holding)
    disclosing = _stored(disclosing_terms(docs, _pairs(held, words)), "disclosing")
    # pairs are counted before they are joined with their texts; of a text's words only those that
    # disclose something meet its entities
    marked = join_lookup(
        words.select("text_hash", "term"), disclosing.select("term").distinct(), ["term"]
    )
    suspects = (
        join_lookup(
            marked.join(held.select("text_hash", "entity"), "text_hash"), disclosing, ["entity", "term"]
        )
        .groupBy("text_hash", "term").agg(F.max("remove").alias("remove"))
    )
    terms = _stored(
        suspects.groupBy("text_hash").agg(
            F.sort_array(F.collect_list(F.struct("term", "remove"))).alias(_TERMS)
        ),
        "terms",
    ).withColumnRenamed("text_hash", _HASH)
    return join_lookup(holding, terms, [_HASH], "left").drop(_HASH)


def _term_places(text: Column, terms: Column) -> Column:
    """Places of the listed terms that do not touch a base place's text."""
    words = F.array_join(F.transform(terms, lambda one: one["term"]), "|")
    pattern = F.concat(
        F.lit(r"(?iu)(?<![\p{L}\p{M}\p{N}])(?:"), words, F.lit(r")(?![\p{L}\p{M}\p{N}])")
    )
    return F.when(terms.isNull(), F.array().cast(_PLACE)).otherwise(
        _places(F.coalesce(text, F.lit("")), pattern).cast(_PLACE)
    )


def _all_places(text: Column) -> Column:
    """Base places of all kinds with their words, then the terms outside of them, by start."""
    places = F.col(_PLACES)

    def marked(kind: str) -> Column:
        return F.transform(places[kind], lambda place: F.struct(
            place["start"].alias("start"), place["end"].alias("end"),
            F.lit(f"[{kind.upper()}]").alias("instead"),
        ))

    base = F.concat(*[marked(kind) for kind in KINDS])
    general = F.transform(_term_places(text, F.col(_TERMS)), lambda place: F.struct(
        place["start"].alias("start"), place["end"].alias("end"),
        F.when(
            F.exists(
                F.col(_TERMS), lambda one: one["remove"] & (one["term"] == F.lower(place["value"]))
            ),
            "",
        ).otherwise("[TERM]").alias("instead"),
    ))
    return let(base, lambda found: F.sort_array(F.concat(found, F.filter(
        general,
        lambda term: ~F.exists(
            found, lambda one: (one["start"] < term["end"]) & (term["start"] < one["end"])
        ),
    ))))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` per row.

    ``spans`` lists all places as kind:start:end, base kinds first and then ``term``. A null text is
    treated like an empty one. Rows with the same id are judged by their own texts.
    """
    found = _with_findings(docs, text_col, [id_col, text_col])
    base = F.concat(*[_named(kind, F.col(_PLACES)[kind]) for kind in KINDS])
    named = found.select(
        F.col(id_col).cast("long").alias("id"), F.col(_PLACES),
        F.array_join(base, ",").alias("base"),
        F.array_join(F.concat(base, _named("term", F.filter(
            _all_places(F.col(text_col)), lambda one: one["instead"].isin("", "[TERM]")
        ))), ",").alias("spans"),
    ).select(
        "id", *[F.size(F.col(_PLACES)[kind]).cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(F.col("base"), 256).alias("base_sha256"), "spans",
    )
    none = docs.filter(~_held(base_places(F.col(text_col)))).select(
        F.col(id_col).cast("long").alias("id"),
        *[F.lit(0).cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(F.lit("").cast("binary"), 256).alias("base_sha256"), F.lit("").alias("spans"),
    )
    return named.unionByName(none)


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every place replaced; all other columns stay, null texts stay null.

    Places that overlap are replaced together, by the words of the one that starts first.
    """
    rows = _with_findings(docs, text_col, docs.columns)
    text = F.col(text_col)
    start = F.struct(F.lit(0).cast("long").alias("done"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, place: Column) -> Column:
        beyond = place["start"] >= state["done"]
        gap = F.substring(text, (state["done"] + 1).cast("int"), (place["start"] - state["done"]).cast("int"))
        return F.struct(
            F.greatest(state["done"], place["end"]).alias("done"),
            F.when(beyond, F.concat(state["parts"], F.array(gap, place["instead"])))
            .otherwise(state["parts"]).alias("parts"),
        )

    cleaned = let(
        F.aggregate(_all_places(text), start, step),
        lambda state: F.concat(
            F.array_join(state["parts"], ""),
            F.substring(text, (state["done"] + 1).cast("int"), F.length(text)),
        ),
    )
    others = docs.filter(~_held(base_places(text)))
    return rows.withColumn(text_col, cleaned).select(*docs.columns).unionByName(others)
