"""Passages across documents, against a plain search and the SQL twin."""

import hashlib
import random
import re

import pytest
from check_oracles import canonical, connect

from vialume.llm import substring_dedup
from vialume.llm.substring_dedup import Shape, difference_cover

GIVEN = "/root/testdata/sf0.001"


def plain(rows, window=50):
    """(n_words, n_removed, digest) of every row (doc_id, text)."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    rank = [2**63 - 1 if d is None else d for d, _ in rows]
    first = {}
    for r, ws in zip(rank, words, strict=True):
        for i in range(len(ws) - window + 1):
            key = tuple(ws[i:i + window])
            first[key] = min(r, first.get(key, r))
    out = []
    for r, ws in zip(rank, words, strict=True):
        gone = set()
        for i in range(len(ws) - window + 1):
            if first[tuple(ws[i:i + window])] < r:
                gone.update(range(i, i + window))
        left = " ".join(w for i, w in enumerate(ws) if i not in gone)
        out.append((len(ws), len(gone), hashlib.sha256(left.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("period", [*range(1, 40), 57, 100])
def test_cover_meets_every_pair_of_places(period):
    cover = set(difference_cover(period))
    for i in range(period):
        assert any(d % period in cover and (d + i) % period in cover for d in range(period))


def passages(seed, n, window):
    """Texts with passages around the length of a window, at many places; repeated rows, null ids and texts."""
    pick = random.Random(seed)
    parts = [[f"p{k}w{i}" for i in range(length)] for k, length in enumerate([window - 1, window, window + 1, 2 * window, 5 * window])]
    parts.append(["a", "b"] * window)
    rows = []
    for d in range(n):
        text = []
        for _ in range(pick.randint(0, 4)):
            text += [f"x{pick.random()}" for _ in range(pick.randint(0, 30))]
            part = pick.choice(parts)
            text += part if pick.random() < 0.6 else part[pick.randint(0, window):]
        rows.append((d, pick.choice([" ", "\n", " \t "]).join(text)))
    rows += [(None, rows[3][1]), (None, " ".join(parts[4])), (7, rows[5][1]), rows[9], rows[9], (n, None), (n + 1, ""), (-5, " ".join(parts[3]))]
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize(("shape", "often"), [(Shape(), 24), (Shape(), 2), (Shape(12, 5), 24), (Shape(9, 9), 3), (Shape(6, 1), 24)])
def test_against_a_plain_search(spark, monkeypatch, shape, often):
    monkeypatch.setattr(substring_dedup, "FREQUENT_ROWS", often)
    rows = passages(sum(shape), 60, shape.window)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = substring_dedup.repeated_words(docs, shape=shape)
    got = sorted((r["rid"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found.collect())
    want = sorted((2**63 - 1 if d is None else d, *w) for (d, _), w in zip(rows, plain(rows, shape.window), strict=True))
    assert got == want
    assert sum(w[2] > 0 for w in want) > 20


def test_frequent_list_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "FREQUENT", 10)
    counts = spark.createDataFrame([(i, 30 if i < 8 else 1000 if i < 12 else 3) for i in range(20)], "c1 long, n long")
    assert substring_dedup.frequent(counts, ["c1"]).column("c1").to_pylist() == [8, 9, 10, 11]


def test_texts_and_other_columns(spark, documents):
    names = ["rid", "th", "of", "row", "n_words", "spans"]
    rows = [(r[0], r[1], *["x"] * len(names)) for r in documents]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    found = substring_dedup.dedup_passages(docs)
    assert found.columns == ["doc_id", "text", "rid", "th", "of", "row", "spans", "n_words", "n_removed"]
    want = {r[0]: w for r, w in zip(documents, plain([r[:2] for r in documents]), strict=True)}
    got = found.collect()
    assert len(got) == len(documents)
    for r in got:
        n, gone, digest = want[r["doc_id"]]
        assert (r["n_words"], r["n_removed"]) == (n, gone)
        if gone:
            assert hashlib.sha256(r["text"].encode()).hexdigest() == digest
    untouched = {r[0]: r[1] for r in documents}
    assert all(r["text"] == untouched[r["doc_id"]] for r in got if not r["n_removed"])


@pytest.mark.parametrize("where", ["small", "given"])
def test_sql_twin(spark, small, where):
    folder = small if where == "small" else GIVEN
    con = connect(GIVEN)
    if where == "small":
        con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT DISTINCT * FROM '{small}/documents.parquet/*.parquet'")
    found = substring_dedup.run(spark, folder)
    twin = con.execute(substring_dedup.SQL)
    names = [d[0] for d in twin.description]
    assert canonical(found.columns, [tuple(r) for r in found.distinct().collect()]) == canonical(names, twin.fetchall())
