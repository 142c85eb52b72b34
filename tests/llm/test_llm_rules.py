"""Quality rules and personal data: native expressions against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from opdiag.llm import pii, quality_rules
from opdiag.llm.queries import QUERIES

BLANK = r"[^\x20\x09-\x0D]+"


def plain_statistics(text):
    text = text or ""
    words = re.findall(BLANK, text)
    lines = [line for line in text.split("\n") if re.search(BLANK, line)]
    windows = Counter(tuple(words[at : at + 5]) for at in range(len(words) - 4))
    inside = {
        place for at in range(len(words) - 4) if windows[tuple(words[at : at + 5])] > 1
        for place in range(at, at + 5)
    }
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(inside),
    )


ODD = [
    (1, None), (2, ""), (3, " \n\n \t"), (4, "a b c d e a b c d e a b c d e"), (5, "x " * 40),
    (6, "é|# é w\nline\nline\n\nline"), (None, "one two three four five six"),
    (7, "a b c d e f a b c d e"), (7, "a b c d e f a b c d e"), (8, "w" * 100_000 + " " + "z y " * 30_000),
]


def test_statistics_against_brute_force(spark):
    given = spark.createDataFrame(ODD, "doc_id long, text string").union(
        spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    )
    rows = given.select("text", quality_rules.statistics(F.col("text")).alias("s")).collect()
    assert [tuple(r.s) for r in rows] == [plain_statistics(r.text) for r in rows]


def test_query_judges_every_document(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op3_quality_rules"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for row in rows:
        stats = plain_statistics(texts[row.doc_id])
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == stats
        assert row.base_failed == (stats[0] < 10 or 100 * stats[4] > 20 * stats[0])
        assert not (row.kept and row.base_failed)


def test_learned_rules_follow_the_labels(spark):
    docs = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{docs}/labels.parquet")
    judged = QUERIES["op3_quality_rules"](spark, docs).join(labels, "doc_id")
    right = judged.filter("not base_failed").agg(
        F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int"))
    ).first()[0]
    assert right > 0.97


def test_rules_are_learned_from_planted_thresholds(spark):
    rows = [
        (part, symbols, symbols > 0.5 and words > 50, words)
        for part in range(3) for symbols in (0.0, 0.2, 0.6, 0.9) for words in range(20, 100, 2)
    ]
    labelled = spark.createDataFrame(rows, "part int, symbols double, low boolean, words long").select(
        "part", "low", F.struct(
            F.col("words").alias("n_words"), (F.col("words") * 5).alias("word_chars"),
            (F.col("words") * F.col("symbols")).cast("long").alias("n_symbols"),
            F.lit(0).cast("long").alias("n_dup_lines"), F.lit(0).cast("long").alias("n_repeat_words"),
        ).alias("stats"),
    )
    rules = quality_rules.learn(labelled)
    assert rules
    kept = quality_rules.verdict(rules, quality_rules.features(F.col("stats")))
    wrong = labelled.filter(kept == F.col("low")).count()
    assert wrong <= 0.03 * labelled.count()


@pytest.mark.parametrize("quality", [[], [(1, None)], [(4, 1), (5, 1)], [(4, 0), (None, 0)]])
def test_rules_without_usable_labels(spark, quality):
    docs = spark.createDataFrame(ODD, "doc_id long, text string").withColumn("kept", F.lit(False))
    labels = spark.createDataFrame(quality, "doc_id long, quality int")
    rows = quality_rules.judged(docs, labels).collect()
    assert len(rows) == len(ODD)
    assert all(row.kept != row.base_failed for row in rows)


def test_rules_use_no_python(spark):
    plan = quality_rules.judged(
        spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    )._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for at, digit in enumerate(reversed(digits)):
        worth = int(digit) * (1 + at % 2)
        total += worth - 9 if worth > 9 else worth
    return total % 10 == 0


def plain_spans(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for match in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", match.group())
            if {
                "email": True, "ip": kind == "ip" and all(int(x) < 256 for x in match.group().split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]:
                found.append((kind, match.start(), match.end()))
    return found


PERSONAL = [
    (1, None), (2, ""), (3, "a@b.c%d@e.f..g@h.i-j. x@1.2.3.4 @a.b a@b a@.c"),
    (4, "1.2.3.4.5 1.2.3 256.1.1.1 0001.02.3.4 1.2.3.4.5.6.7.8 9999999999999999.1.1.1"),
    (5, "4111 1111 1111 1111, 4111-1111-1111-1112 4111  1111 1111 1111 é378282246310005"),
    (6, "+49 (0)30 123456 +1 2 3 +12345678901234567 ++44 20 7946 0958. +1(((( "),
    (None, "mail z@y.xx now"), (7, "x" * 50_000 + "@" + "a." * 20_000 + "b"), (8, "1" * 30_000),
    (9, "+1" + " " * 30_000 + "x"), (10, "call 1.2.3.4 " * 3000), (10, "call 1.2.3.4 " * 3000),
]


def check_spans(rows, texts):
    for row in rows:
        spans = plain_spans(texts[row.id])
        joined = ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)
        counts = Counter(kind for kind, _, _ in spans)
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), row.id
        assert row.spans.startswith(joined)
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [
            counts[kind] for kind in ("email", "ip", "card", "phone")
        ]


def test_base_spans_of_odd_texts(spark):
    docs = spark.createDataFrame(PERSONAL, "doc_id long, text string").withColumn("id", F.lit("x"))
    rows = pii.personal_data(docs).collect()
    assert len(rows) == len(PERSONAL)
    check_spans(rows, dict(PERSONAL))


def test_base_spans_of_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op5_pii"](spark, SMALL).withColumnRenamed("doc_id", "id").collect()
    assert len(rows) == len(texts)
    check_spans(rows, texts)


def test_terms_that_give_an_entity_away(spark):
    plain = [(at, f"the report of day {at} was long and dull") for at in range(100, 160)]
    named = [
        (1, "Zelinka wrote the report, ask anna@x.org about it"),
        (2, "mail anna@x.org or ZELINKA, who was long away"),
        (3, "Zelinka is far from any address here"),
        (4, "once only: quixotic bob@y.org"),
    ]
    docs = spark.createDataFrame(plain + named, "doc_id long, text string")
    rows = {row.id: row.spans for row in pii.personal_data(docs).collect()}
    # The name stands in 3 texts, in 2 of them near the address: PMI is 0.88 of the information.
    assert rows[1] == "email:30:40,term:0:7" and rows[2] == "email:5:15,term:19:26"
    assert rows[3] == "" and rows[4] == "email:20:29"
    clean = {row.doc_id: row.text for row in pii.sanitised(docs).collect()}
    assert clean[1] == "[TERM] wrote the report, ask [EMAIL] about it"
    assert clean[3] == named[2][1] and clean[4] == "once only: quixotic [EMAIL]"
    assert all(clean[key] == text for key, text in plain)


def test_terms_that_only_stand_by_the_entity_are_removed(spark):
    plain = [(at, f"some text of number {at}") for at in range(100, 130)]
    named = [(1, "Orlova a@x.org"), (2, "dear Orlova: a@x.org")]
    docs = spark.createDataFrame(plain + named, "doc_id long, text string")
    clean = {row.doc_id: row.text for row in pii.sanitised(docs).collect()}
    assert clean[1] == " [EMAIL]" and clean[2] == "dear : [EMAIL]"


def test_terms_count_over_whole_texts(spark):
    plain = [(at, f"some text of number {at}") for at in range(100, 160)]
    filler = "some text of number " * 10
    named = [
        (1, f"Orlova {filler} a@x.org"), (2, f"a@x.org {filler} by Orlova"),
        (3, "Novak, born 1985, card 4111 1111 1111 1111"), (4, "card 4111 1111 1111 1111, 1999, Novak"),
        (5, "Svobod, c@y.org"), (6, f"c@y.org {filler} Svobod"), (6, f"c@y.org {filler} Svobod"),
    ]
    docs = spark.createDataFrame(plain + named, "doc_id long, text string")
    found = pii.disclosing_terms(docs, pii.entity_terms(docs, "text")).collect()
    assert {tuple(row) for row in found} >= {
        ("email:a@x.org", "orlova", True), ("card:4111111111111111", "novak", True),
        ("email:c@y.org", "svobod", True),
    }
    assert not {"some", "text", "org"} & {row.term for row in found}


def plain_disclosing(texts):
    """Pairs over the thresholds from dictionaries; words, values and classes as sets per text."""
    total, with_term, rows, held = len(texts), {}, {}, {}
    for text in texts:
        places = {
            kind: [m.group() for m in re.finditer(pattern, text)] for kind, pattern in (
                ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
                ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
            )
        }
        bare = text
        for values in places.values():
            for value in values:
                bare = bare.replace(value, "\n")
        words = set(re.findall(r"\w+", bare.lower()))
        entities = set()
        for value in map(str.lower, places["email"]):
            owner, domain = value.rsplit("@", 1)
            entities |= {f"email:{value}", f"owner:{owner}", f"domain:{domain}", "class:email"}
        for value in places["phone"]:
            digits = re.sub("[^0-9]", "", value)
            entities |= {f"phone:{digits}", f"area:{digits[:5]}", "class:phone"}
        for word in words:
            with_term[word] = with_term.get(word, 0) + 1
        if entities:
            rows[text] = rows.get(text, 0) + 1
            held[text] = (entities, words)
    with_entity, support, both, together = {}, {}, {}, {}
    for text, (entities, words) in held.items():
        for entity in entities:
            with_entity[entity] = with_entity.get(entity, 0) + rows[text]
            support[entity] = support.get(entity, 0) + 1
            for word in words:
                both[entity, word] = both.get((entity, word), 0) + rows[text]
                together[entity, word] = together.get((entity, word), 0) + 1
    out = set()
    for (entity, word), count in both.items():
        least = pii.SUPPORT if entity.split(":")[0] in pii.KINDS else pii.LEVEL_SUPPORT
        if together[entity, word] < least or with_term[word] < pii.SUPPORT:
            continue
        pmi = math.log2(count * total / (with_entity[entity] * with_term[word]))
        information = math.log2(total / with_entity[entity])
        if pmi > 0 and pmi >= pii.GENERALISE * information - 1e-9:
            out.add((entity, word, pmi >= pii.REMOVE * information - 1e-9))
    return out


def test_terms_equal_brute_force_mutual_information(spark):
    draw = random.Random(9)
    words = [f"w{at}" for at in range(40)]
    texts = []
    for at in range(220):
        own = [draw.choice(words) for _ in range(6)]
        if at % 9 == 0:
            who = draw.choice("abc")
            own += [f"name{who}", f"{who}@{draw.choice('xy')}.org", "write"]
        if at % 13 == 0:
            own += ["call", f"+4930 {draw.choice((1234567, 7654321))}"]
        draw.shuffle(own)
        texts += [" ".join(own)] * (3 if at % 40 == 0 else 1)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {tuple(row) for row in pii.disclosing_terms(docs, pii.entity_terms(docs, "text")).collect()}
    want = plain_disclosing(texts)
    assert found == want
    # classes and shared parts are among them, not only single values
    assert {("class:phone", "call", True), ("class:email", "write", True)} <= want
    rows = pii.personal_data(docs).collect()
    spans = {row.id: row.spans for row in rows}
    for at, text in enumerate(texts):
        assert ("term:" in spans[at]) == (" call" in f" {text}" or "write" in text)
        assert spans[at] or not re.search("[@+]", text)


def test_terms_go_wherever_they_stand_beside_the_entity(spark):
    plain = [(at, f"some text of number {at}") for at in range(100, 160)]
    filler = "some text of number " * 10
    named = [
        (1, "Orlova a@x.org"), (2, "a@x.org Orlova"), (3, f"Orlova: {filler}a@x.org"),
        (None, f"Orlova: {filler}a@x.org"), (4, "the name Novak b@x.org"),
    ]
    docs = spark.createDataFrame(plain + named, "doc_id long, text string")
    clean = {row.doc_id: row.text for row in pii.sanitised(docs).collect()}
    assert clean[3] == clean[None] == f": {filler}[EMAIL]"
    assert clean[4] == "the name Novak [EMAIL]" and all(clean[key] == text for key, text in plain)


def test_any_word_can_be_a_term(spark):
    plain = [(at, f"some text of number {at}") for at in range(100, 160)]
    named = [(1, "Ng 7x21 e\u0301va a@x.org"), (2, "a@x.org 7X21 E\u0301va NG")]
    docs = spark.createDataFrame(plain + named, "doc_id long, text string")
    clean = {row.doc_id: row.text for row in pii.sanitised(docs).collect()}
    assert clean[1] == "   [EMAIL]" and clean[2] == "[EMAIL]   "
    assert all(clean[key] == text for key, text in plain)


def test_sanitised_rows_keep_their_columns(spark):
    docs = spark.createDataFrame(PERSONAL, "doc_id long, text string").select(
        F.lit(1).alias("id"), "text", "doc_id", F.lit(2).alias("terms")
    )
    clean = pii.sanitised(docs)
    assert clean.columns == docs.columns
    rows = clean.collect()
    assert len(rows) == len(PERSONAL)
    for row in rows:
        if row.text is None:
            assert row.doc_id == 1
        else:
            assert not [x for x in plain_spans(row.text) if x[0] != "phone"]
    assert pii.sanitised(docs.limit(0)).count() == 0


def test_overlapping_places_leave_nothing_behind(spark):
    docs = spark.createDataFrame([(1, "go +1.2.3.4.555555 x@5.6.7.8 end")], "doc_id long, text string")
    assert pii.sanitised(docs).first().text == "go [PHONE] [EMAIL] end"


def test_personal_data_uses_no_python(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for frame in (pii.personal_data(docs), pii.sanitised(docs)):
        plan = frame._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan
