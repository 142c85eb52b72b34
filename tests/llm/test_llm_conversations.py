"""Prefix trie and structure repair of conversations against plain versions of the same."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from opdiag.llm import prefix_trie, structure_repair
from opdiag.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
SPACES = " \t\n\x0b\f\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_trie(sequences):
    """Every node by (conv_id, depth), from a dictionary of all prefixes."""
    members, children = defaultdict(list), defaultdict(set)
    for conv, turns in sequences.items():
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(conv)
            if depth:
                children[tuple(turns[: depth - 1])].add(tuple(turns[:depth]))
    nodes, below = {}, {}
    for prefix in sorted(members, key=len, reverse=True):
        own, words = members[prefix], len(WORD.findall(prefix[-1][1])) if prefix else 0
        leaves = sum(below[child][0] for child in children[prefix]) or 1
        saved = sum(below[child][1] for child in children[prefix]) + (len(own) - 1) * words
        below[prefix] = leaves, saved
        ends = sorted(conv for conv in own if len(sequences[conv]) == len(prefix))
        nodes[min(own), len(prefix)] = (
            min(members[prefix[:-1]]) if prefix else None, len(own), len(children[prefix]), leaves,
            saved, sha(",".join(map(str, ends))),
        )
    return nodes


def in_order(rows):
    sequences = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            sequences[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [(r, t) for *_, r, t in sorted(turns)] for conv, turns in sequences.items()}


def rebuilt(sequences):
    heads = {conv: zlib.crc32(str(conv).encode()) % 4 for conv in sequences}
    return {
        conv: sequences.get(conv - conv % 20, [])[: heads[conv]] + turns[heads[conv] :]
        for conv, turns in sequences.items()
    }


def found_nodes(frame):
    rows = frame.collect()
    nodes = {
        (r.conv_id, r.depth): (
            r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256
        ) for r in rows
    }
    assert len(nodes) == len(rows)
    return nodes


def random_turns(seed):
    random.seed(seed)
    rows = [
        (conv, turn, random.choice(["user", None]), random.choice(["x y", "z", None]))
        for conv in random.sample(range(200), 60) for turn in range(random.choice([1, 2, 3, 6, 9]))
    ]
    # three long ones, two of them equal, and one that ends where the others go on
    rows += [(conv, turn, "user", "hot") for conv in (211, 212) for turn in range(11)]
    rows += [(213, turn, "user", "hot" if turn < 9 else "own") for turn in range(13)]
    rows += [(205, turn, "user", "hot") for turn in range(8)]
    # copies of one conversation; a block without its first conversation; odd turns
    rows += [(conv, turn, "user", f"t{turn}") for conv in range(300, 340) for turn in range(3)]
    rows += [(421, None, "user", "late"), (421, 7, "user", "seven"), (None, 1, "user", "nobody")]
    random.shuffle(rows)
    return rows


@pytest.mark.parametrize("width, shard_rows", [(4, 20), (32, 1 << 14)])
def test_trie_equals_all_prefixes(spark, width, shard_rows):
    rows = random_turns(7)
    turns = spark.createDataFrame(rows, SCHEMA).withColumn("depth", F.lit("x")).repartition(3)
    ids = prefix_trie.turn_ids(turns)
    original = in_order(rows)
    found = found_nodes(prefix_trie.nodes(*prefix_trie.rebuilt(ids), width, shard_rows))
    assert found == plain_trie(rebuilt(original))
    if width > 4:
        as_is = prefix_trie.nodes(*prefix_trie.numbered_turns(ids), width, shard_rows)
        assert found_nodes(as_is) == plain_trie(original)


def test_trie_of_one_crowded_conversation(spark):
    """A conversation over several shards of the numbering; its tail has no company."""
    rows = [(20, turn, "user", f"text {turn % 7}") for turn in range(500)]
    rows += [(21, turn, "user", f"text {turn}") for turn in range(3)]
    turns = spark.createDataFrame(rows, SCHEMA).repartition(4)
    with_parts = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(with_parts, "false")
    try:
        ids = prefix_trie.turn_ids(turns)
        want = plain_trie(rebuilt(in_order(rows)))
        assert found_nodes(prefix_trie.nodes(*prefix_trie.rebuilt(ids), width=16)) == want
    finally:
        spark.conf.unset(with_parts)


def test_trie_query_covers_every_conversation(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect()]
    want = plain_trie(rebuilt(in_order(rows)))
    assert found_nodes(QUERIES["op12_prefix_trie"](spark, SMALL)) == want


def test_trie_of_an_empty_table(spark):
    assert prefix_trie.rebuilt_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def plain_damage(rows):
    out = defaultdict(list)
    for row in rows:
        conv, turn, role, text = (" " if value is None else str(value) for value in row)
        kind = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        copies = {0: 0, 3: 2}.get(kind, 1)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out[row[0]] += [(row[1], "user" if kind == 4 else role, text)] * copies
    return {
        conv: sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        for conv, own in out.items()
    }


def plain_faults(rows):
    seen, faults = set(), []
    for _, role, text in rows:
        end = text.rstrip(SPACES)[-1:]
        faults.append(1 if not end else 2 if (role, text) in seen else 3 if end not in ".!?" else 0)
        seen.add((role, text))
    return faults


def plain_repair(rows):
    """All ways through the rows that are not far dearer than the cheapest, as whole strings."""
    faults = plain_faults(rows)

    def inserted(ways):
        found = new = set(ways)
        for _ in range(2):
            new = {
                (state + role[0], cost + 2, (*edits, ("I", role, "")))
                for state, cost, edits in new for role in ("user", "assistant")
                if re.fullmatch("s?(ua)*u?", state + role[0])
            }
            found = found | new
        return found

    ways = inserted({("", 0, ())})
    for (_, role, text), fault in zip(rows, faults):
        new = {(state, cost + 3, (*edits, ("D", role, text))) for state, cost, edits in ways}
        if fault not in (1, 2):
            for state, cost, edits in ways:
                for letter, own, price in (("K", role, 0), ("R", "user", 2), ("R", "assistant", 2)):
                    if own and re.fullmatch("s?(ua)*u?", state + own[0]):
                        price += fault == 3
                        new.add((state + own[0], cost + price, (*edits, (letter, own, text))))
        ways = inserted(new)
        least = min(cost for _, cost, _ in ways)
        ways = {way for way in ways if way[1] <= least + 8}
    cost, audit, edits = min(
        (cost, "".join(letter for letter, *_ in edits), edits)
        for state, cost, edits in ways if re.fullmatch("(s?(ua)+)?", state)
    )
    turns = [turn for turn, *_ in rows if turn is not None]
    initials = [role[:1] for _, role, _ in rows]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(faults.count(fault) for fault in (1, 2, 3)),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost, audit, sha("\n".join(f"{r}:{t}" for letter, r, t in edits if letter != "D")),
    )


def searched(rows):
    search, edits = structure_repair.Search(), []
    for row, fault in zip(rows, plain_faults(rows)):
        edits += search.add((*row, fault))
    edits += search.end()
    assert search.waiting == 0
    return search.cost, "".join(edit[0] for edit in edits), edits


def test_search_equals_all_ways():
    random.seed(11)
    for _ in range(400):
        roles = random.choice(
            [["user", "assistant"], ["user", "assistant", "system", "tool", ""], ["tool"], ["system", "user"]]
        )
        rows = [
            (at, random.choice(roles), random.choice(["Hi.", "a", "", "b!", f"t{at}."]))
            for at in range(random.randint(0, 6))
        ]
        cost, audit, edits = searched(rows)
        want = plain_repair(rows)
        assert (cost, audit) == want[5:7]
        assert sha("\n".join(f"{r}:{t}" for *_, r, t, stays in edits if stays)) == want[7]


def test_settled_rows_do_not_wait():
    """Sound turns are emitted while the search goes on; turns without any sound role wait."""
    search = structure_repair.Search()
    most = 0
    for at in range(5000):
        list(search.add((at, ("user", "assistant")[at % 2], f"t{at}.", 0)))
        most = max(most, search.waiting)
    assert most < 40
    cost, audit, _ = searched([(at, "tool", f"t{at}.") for at in range(3001)])
    assert (cost, audit) == (6003, "D" + "R" * 3000)


ODD = [
    (1, 0, "user", "Fine."), (1, 1, None, None), (1, 2, "assistant", "cut b"),
    (2, None, "user", "No turn."), (2, None, "user", "No turn."), (None, None, None, None),
    (None, 1, "user", "Nobody's"), (3, 5, "", "Empty role."), (3, 9, "assistant", "x\x0b\n"),
    (4, 1, "user", "a" * 200_000), (4, 2, "assistant", "ends with 0"), (5, 3, "assistant", "f."),
]


def summary_rows(frame):
    return {row[0]: tuple(row)[1:] for row in frame.collect()}


def test_repair_of_odd_rows(spark):
    turns = spark.createDataFrame(ODD, SCHEMA).withColumn("fault", F.lit(9)).repartition(3)
    got = summary_rows(structure_repair.summaries(structure_repair.damaged(turns)))
    assert got == {conv: plain_repair(rows) for conv, rows in plain_damage(ODD).items()}
    empty = structure_repair.damaged(spark.createDataFrame([], SCHEMA))
    assert structure_repair.summaries(empty).count() == 0


def test_edits_give_the_repaired_turns(spark):
    rows = [(1, 0, "assistant", "A."), (1, 1, "user", "B."), (1, 2, "user", "B."), (1, 3, "assistant", "C.")]
    edits = structure_repair.edits(spark.createDataFrame(rows, SCHEMA)).orderBy("step").collect()
    assert [(e.edit, e.turn, e.role, e.text, e.in_repair) for e in edits] == [
        ("I", None, "user", "", True), ("K", 0, "assistant", "A.", True), ("K", 1, "user", "B.", True),
        ("D", 2, "user", "B.", False), ("K", 3, "assistant", "C.", True),
    ]


def test_repair_query_covers_every_conversation(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect()]
    got = summary_rows(QUERIES["op13_structure_repair"](spark, SMALL))
    assert got == {conv: plain_repair(own) for conv, own in plain_damage(rows).items()}
