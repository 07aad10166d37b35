"""The trie against a plain one and the SQL twin."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from check_oracles import canonical, connect
from pyspark.sql import functions as F

from vialume.llm import prefix_trie as trie

GIVEN = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, depth string, k long, bytes string"


def plain(rows):
    """Nodes from a dictionary of prefixes; rows are (conv_id, turn, role, text)."""
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append(((turn is not None, turn or 0), (role or "").encode(), (text or "").encode()))
    turns = {c: [r[1:] for r in sorted(found)] for c, found in by.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = [*turns.get(c - c % 5, [])[:h], *own[h:]]
    nodes = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            nodes[tuple(seq[:d])].append(c)
    children, below = defaultdict(int), defaultdict(lambda: [0, 0])
    for key in nodes:
        if key:
            children[key[:-1]] += 1
    for key, members in nodes.items():
        for d in range(len(key) + 1):
            below[key[:d]][0] += key not in children
            below[key[:d]][1] += (len(members) - 1) * (len(key[-1][1]) if key else 0)
    out = []
    for key, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(key))
        out.append((min(members), len(key), min(nodes[key[:-1]]) if key else None, len(members), children.get(key, 0), *below[key],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(seed, n, longest):
    pick = random.Random(seed)
    rows = []
    for c in range(n):
        if pick.random() < 0.1:
            continue
        length = pick.choice([1, 2, 3, 5, 8, 9, pick.randint(1, longest)])
        for t in range(length):
            role = pick.choice(["user", "user", None])
            rows.append((c, pick.choice([t, t, None]), role, "same" if t < 20 and pick.random() < 0.9 else pick.choice(["é" * t, "", None, f"other {c}"])))
    hot = [(1000 + i, t, "user", f"line {t}") for i in range(60) for t in range(7)]
    return [*rows, *hot, *rows[:3], (None, 0, "user", "x"), (None, None, None, None)]


def saved(spark, folder, rows):
    spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(3).write.parquet(f"{folder}/conversations.parquet")


@pytest.mark.parametrize(("seed", "n", "longest", "cuts"), [(1, 40, 70, 3), (2, 25, 30, 1), (3, 10, 9, 2), (4, 3, 200, 2), (5, 6, 8, 3)])
def test_against_a_plain_trie(spark, tmp_path, rows, seed, n, longest, cuts):
    given = conversations(seed, n, longest)
    saved(spark, tmp_path, given)
    turns = trie.numbered_turns(spark.read.parquet(f"{tmp_path}/conversations.parquet"))
    assert rows(trie.prefix_trie(*trie.rebuilt(turns), cuts=cuts)) == plain(given)


def test_one_conversation_with_most_rows(spark, tmp_path, rows):
    given = [(5, t, "u", f"t{t % 7}") for t in range(700)] + [(6, t, "u", f"t{t % 7}") for t in range(30)]
    saved(spark, tmp_path, given)
    assert rows(trie.run(spark, str(tmp_path))) == plain(given)


def test_order_does_not_depend_on_partitions(spark, rows):
    turns = spark.range(5000).select(F.lit(1).alias("conv_id"), (F.col("id") * 7 % 5000).alias("turn"), F.lit("u").alias("role"),
                                     (F.col("id") * 7 % 5000).cast("string").alias("text")).repartition(9)
    found = trie.numbered_turns(turns)
    want = spark.range(5000).select(F.col("id").alias("k"), F.xxhash64(F.lit("u"), F.col("id").cast("string")).alias("a"))
    assert found.select("k", "a").exceptAll(want).isEmpty() and found.count() == 5000


def test_empty_table(spark, tmp_path):
    saved(spark, tmp_path, [])
    assert trie.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("where", ["made", "given"])
def test_sql_twin(spark, tmp_path, where):
    con, folder = connect(GIVEN), GIVEN
    if where == "made":
        saved(spark, tmp_path, conversations(9, 30, 40))
        folder = str(tmp_path)
        con.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet/*.parquet'")
    found = trie.run(spark, folder)
    twin = con.execute(trie.SQL)
    names = [d[0] for d in twin.description]
    assert canonical(found.columns, [tuple(r) for r in found.collect()]) == canonical(names, twin.fetchall())
