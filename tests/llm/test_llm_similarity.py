"""Similarity join, components and decontamination against brute force and DuckDB."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from compare import compare, duck
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from opdiag.llm import components, decontamination, jaccard_join, texts
from opdiag.llm.oracle import SQL
from opdiag.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall("[a-z0-9\x80-\U0010ffff]+", (text or "").translate(LOWER))


def shingles_of(text, short=True):
    words = words_of(text)
    if not words or (len(words) < 5 and not short):
        return frozenset()
    return frozenset(" ".join(words[at : at + 5]) for at in range(max(1, len(words) - 4)))


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_match_their_sql(spark, name):
    _, problems = compare(spark, duck(SMALL), QUERIES[name], SQL[name], SMALL)
    assert not problems


@given(st.lists(st.one_of(st.none(), st.text("ab É.\n1", max_size=40)), max_size=8))
@settings(max_examples=120, deadline=None)
def test_shingles_of_a_column(given_texts):
    column = pa.array(given_texts, pa.string())
    counts, sizes = [0] * len(given_texts), [0] * len(given_texts)
    for start, hashes, at, totals in texts.text_shingles(column):
        hashes, at = texts.distinct_by_text(hashes, at)
        for text, size in enumerate(np.bincount(at, minlength=len(totals))):
            counts[start + text], sizes[start + text] = int(totals[text]), int(size)
    assert counts == [len(words_of(text)) for text in given_texts]
    assert sizes == [len(shingles_of(text)) for text in given_texts]


def test_long_texts_are_cut_between_words(monkeypatch):
    column = pa.array(["Aa bb-cc dd ee ff gg " * 40, None, "x" * 300, "aa bb cc dd ee ff gg"])
    whole = [(start, sorted(h.tolist())) for start, h, _, _ in texts.text_shingles(column)]
    monkeypatch.setattr(texts, "PIECE", 64)
    cut = {}
    for start, hashes, at, _ in texts.text_shingles(column):
        for value, text in zip(hashes.tolist(), at.tolist()):
            cut.setdefault(start + text, []).append(value)
    assert sorted(sum(cut.values(), [])) == sorted(sum((x for _, x in whole), []))


def brute_groups(rows, threshold=0.8):
    """group id and links per row number."""
    sets = [shingles_of(text) for _, text in rows]
    up = list(range(len(rows)))

    def root(at):
        while up[at] != at:
            at = up[at]
        return at

    links = [0] * len(rows)
    for x in range(len(rows)):
        for y in range(x):
            common = len(sets[x] & sets[y])
            if common and common >= threshold * (len(sets[x]) + len(sets[y]) - common):
                links[x] += 1
                links[y] += 1
                up[root(x)] = root(y)
    least = {}
    for at, (key, _) in enumerate(rows):
        if key is not None:
            least[root(at)] = min(key, least.get(root(at), key))
    return [(rows[at][0], least.get(root(at)), links[at]) for at in range(len(rows))]


def family(seed, count, length, changes):
    draw = random.Random(seed)
    base = [f"w{seed}x{draw.randrange(10**6)}" for _ in range(length)]
    for _ in range(count):
        words = list(base)
        for _ in range(draw.randrange(changes + 1)):
            words[draw.randrange(length)] = f"n{draw.randrange(10**6)}"
        yield " ".join(words)


def test_similar_documents_against_brute_force(spark):
    draw = random.Random(1)
    made = [text for seed in range(25) for text in family(seed, draw.randrange(1, 9), 120, 8)]
    made += ["One two, three!", "one TWO three", "one two", "", "...", "", "é é é é é é", "É É É É É É"]
    made += [made[0]] * 30
    rows = list(enumerate(made)) + [(None, made[3]), (None, "no other text has these words"), (7, made[7]),
                                    (7, "the same id but quite another text here"), (900, None), (901, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "doc_id", "text", F.lit("x").alias("id"), F.lit(1).alias("class_id")
    )
    found = jaccard_join.similar_documents(docs.repartition(3)).collect()
    key = lambda row: tuple(-1 if x is None else x for x in row)
    expected = []
    for row in brute_groups(rows):
        expected.append(row)
    # rows without words stay alone
    assert sorted(((r.id, r.class_id, r.n_links) for r in found), key=key) == sorted(expected, key=key)


def test_one_row_of_each_group_stays(spark):
    rows = list(enumerate(text for seed in range(6) for text in family(seed, 5, 100, 3)))
    rows += [(2, rows[2][1]), (0, rows[0][1]), (50, ""), (50, ""), (51, None), (None, rows[6][1]),
             (None, "alone without an id at all"), (None, "alone without an id at all")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(3))
    kept = jaccard_join.one_per_group(docs)
    assert kept.columns == docs.columns
    names = [(r.doc_id, r.text) for r in kept.collect()]
    groups = brute_groups(rows)
    heads = {group for (_, group, _), (_, text) in zip(groups, rows) if words_of(text)} - {None}
    expected = [(key, dict(rows[:30]).get(key)) for key in heads]
    expected += [(50, ""), (50, ""), (51, None), (None, "alone without an id at all")]
    assert sorted(names, key=str) == sorted(expected, key=str)


def test_a_tight_group_is_split_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    monkeypatch.setattr(jaccard_join, "SMALL", 8)
    monkeypatch.setattr(jaccard_join, "TIGHT_BLOCK", 16)
    rows = list(enumerate(family(3, 90, 150, 6)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard_join.similar_documents(docs).collect()
    assert sorted((r.id, r.class_id, r.n_links) for r in found) == sorted(brute_groups(rows))


def test_no_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert jaccard_join.similar_documents(empty).count() == 0
    assert jaccard_join.one_per_group(empty).count() == 0
    assert decontamination.contained_items(empty, items).count() == 0
    assert decontamination.without_items(empty, items).count() == 0


def test_runs_reach_the_wanted_recall():
    for threshold, miss in ((0.8, 1e-6), (0.5, 1e-3)):
        runs = jaccard_join.runs_needed(threshold, miss)
        assert (1 - threshold**jaccard_join.DEPTH) ** runs <= miss


@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=14))
@settings(max_examples=6, deadline=None)
def test_components(spark, links):
    up = {node: node for link in links for node in link if link[0] != link[1]}

    def root(node):
        while up[node] != node:
            node = up[node]
        return node

    for a, b in links:
        if a != b:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    frame = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    found = {r.node: r.root for r in components.components(frame).collect()}
    assert found == {node: root(node) for node in up}


def windows_of(text, size):
    words = words_of(text)
    return {tuple(words[at : at + size]) for at in range(len(words) - size + 1)} if size else set()


def brute_contained(docs, items, threshold=0.8):
    out = set()
    for doc, text in docs:
        held = {size: windows_of(text, size) for size in range(1, 6)}
        for item, wanted in items:
            size = min(len(words_of(wanted)), 5)
            wanted, held_here = windows_of(wanted, size), held.get(size, set())
            if wanted and len(wanted & held_here) >= threshold * len(wanted):
                out.add((doc, item, len(wanted), len(wanted & held_here)))
    return out


def test_contained_items_against_brute_force(spark):
    draw = random.Random(2)
    items = [(at, text) for at in range(30) for text in family(100 + at, 1, draw.choice((5, 6, 9, 40)), 0)]
    items += [(90, None), (91, ""), (92, "too short an item"), (3, "one more text under the id of another"),
              (None, "an item that has no id of its own"), (0, items[0][1])]
    docs = []
    for at in range(60):
        words = [f"d{draw.randrange(10**6)}" for _ in range(400)]
        for _ in range(draw.randrange(3)):
            inside = (draw.choice(items)[1] or "").upper().split()
            for _ in range(draw.randrange(3)):
                if inside:
                    inside[draw.randrange(len(inside))] = "changed"
            place = draw.randrange(400)
            words[place:place] = inside
        docs.append((at, ", ".join(words)))
    docs += [(200, None), (201, ""), (7, docs[7][1]), (8, "the same id with another text"),
             (None, "x " + items[1][1] + " y")]
    found = decontamination.contained_items(
        spark.createDataFrame(docs, "doc_id long, text string").withColumn("item", F.lit(1)),
        spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1)),
    ).collect()
    got = [(r.id, r.item_id, r.n_shingles, r.n_shared) for r in found]
    assert sorted(got, key=str) == sorted(brute_contained(docs, items), key=str)
    kept = decontamination.without_items(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    hit = {text for key, text in docs if brute_contained([(key, text)], items)}
    assert sorted((tuple(r) for r in kept.collect()), key=str) == sorted(
        (row for row in docs if row[1] not in hit), key=str
    )


def test_short_items_are_found_whole(spark):
    docs = spark.createDataFrame(
        [(1, "Paris is the Capital of France, they say"), (2, "the capital, of France"), (3, "capital of the France"),
         (4, "yes"), (5, "oh yes"), (6, None), (7, "the capital of")], "doc_id long, text string")
    items = spark.createDataFrame(
        [(1, "the capital of France"), (2, "Yes!"), (3, "")], "item_id long, text string")
    found = decontamination.contained_items(docs, items).collect()
    assert sorted((r.id, r.item_id, r.n_shingles, r.n_shared) for r in found) == [
        (1, 1, 1, 1), (2, 1, 1, 1), (4, 2, 1, 1), (5, 2, 1, 1)
    ]


@pytest.mark.parametrize("count", [60, 120])
def test_a_shared_template_makes_few_candidates(spark, count):
    template = "which of these twelve words is the one that fits here best"
    draw = random.Random(4)
    own = lambda: " ".join(f"w{draw.randrange(10**6)}" for _ in range(25))
    item_rows = [(at, f"{template} {own()}") for at in range(count)]
    items = spark.createDataFrame(item_rows, "id long, text string").select(
        "id", F.xxhash64("text").alias("text_hash"), "text"
    )
    shingles = decontamination._item_shingles(items).select(
        F.xxhash64("id", "text_hash").alias("item"), "shingle"
    ).distinct()
    sizes = shingles.groupBy("item").agg(F.count(F.lit(1)).alias("n_shingles"))
    sketches = decontamination._sketches(shingles, sizes, 0.8)
    # no shingle of the template is in a sketch, so a text that only has the template is no candidate
    assert sketches.groupBy("shingle").count().where("count > 1").count() == 0
    docs = [(at, f"{template} {own()}") for at in range(count)] + [(10**6, item_rows[3][1])]
    found = decontamination.contained_items(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(item_rows, "item_id long, text string"),
    ).collect()
    assert [(r.id, r.item_id) for r in found] == [(10**6, 3)]


def test_repeated_rows_give_one_set_to_their_family(spark):
    text = " ".join(f"w{at}" for at in range(60))
    rows = [(1, text)] * 600 + [(None, text + " more")] * 300 + [(2, "another text of six words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = jaccard_join.shingle_sets(docs, "doc_id", "text").dropDuplicates(["high", "low"])
    members = sets.select(
        F.lit(1).cast("long").alias("family"), F.xxhash64("high", "low").alias("set_id"),
        F.lit(1).cast("long").alias("shares"), "high", "low", "id", "text_hash",
    )
    found = jaccard_join._family_sets(docs, members, "doc_id", "text")
    assert sorted(len(row.hashes) for row in found.collect()) == [1, 56, 57]
    counted = jaccard_join.similar_documents(docs).groupBy("id", "class_id", "n_links").count().collect()
    assert {tuple(row) for row in counted} == {(1, 1, 899, 600), (None, 1, 899, 300), (2, 2, 0, 1)}
