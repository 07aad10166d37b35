"""The operators against plain Python, SQL twins and published libraries, on small awkward tables."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from check_oracles import canonical, connect
from pyspark.sql import functions as F

import corpus_pipeline
from vialume.llm import (byte_bpe, jaccard_join, license_scan, line_dedup, llm_queries, multi_index, packing,
                         quality_classifier, quality_rules, sharding, url_filter)

GIVEN = "/root/testdata/sf0.001"


def collected(df):
    return [r.asDict() for r in df.collect()]


@pytest.mark.parametrize("module", [url_filter, quality_rules])
@pytest.mark.parametrize("where", ["small", "given"])
def test_sql_twins(spark, small, module, where):
    folder = small if where == "small" else GIVEN
    con = connect(GIVEN)
    if where == "small":
        for name in ("documents", "pages"):
            con.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet/*.parquet'")
        if module is quality_rules:  # the twin counts by id
            con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT DISTINCT * FROM '{small}/documents.parquet/*.parquet'")
    found = module.run(spark, folder)
    rows = [tuple(r) for r in (found if where == "given" else found.distinct()).collect()]
    twin = con.execute(module.SQL)
    names = [d[0] for d in twin.description]
    want = twin.fetchall()
    if where == "small" and module is quality_rules:  # repeated rows count for their host, so only the counts compare
        rows = [tuple(v for n, v in zip(found.columns, r, strict=True) if n != "kept") for r in rows]
        want = [tuple(v for n, v in zip(names, r, strict=True) if n != "kept") for r in want]
        names = [n for n in names if n != "kept"]
        assert canonical(names, rows) == canonical(names, want)
    else:
        assert canonical(found.columns, rows) == canonical(names, want)


def plain_line_dedup(rows):
    """Lines left of every distinct (id, text), in the order of ids."""
    seen, left = set(), {}
    blank = " \t\n\x0b\x0c\r"
    for doc, text in sorted(set(rows), key=lambda r: r[0]):
        lines = (text or "").split("\n")
        full = [(i, l.strip(blank)) for i, l in enumerate(lines) if l.strip(blank)]
        gone = set()
        for a, b, c in zip(full, full[1:], full[2:]):
            key = (a[1], b[1], c[1])
            if key in seen:
                gone.update(range(a[0], c[0] + 1))
            seen.add(key)
        left[doc] = (len(gone), "\n".join(l for i, l in enumerate(lines) if i not in gone) if gone else text)
    return left


def test_line_dedup(spark, small, documents):
    want = plain_line_dedup([r[:2] for r in documents])
    got = collected(line_dedup.run(spark, small))
    assert len(got) == len(documents)
    assert {r["doc_id"]: (r["n_removed"], r["text"]) for r in got} == want
    assert sum(n > 0 for n, _ in want.values()) > 12


def test_line_dedup_keeps_other_columns(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert line_dedup.dedup_lines(docs).columns == [*docs.columns, "n_lines", "n_removed"]


def test_sharding(spark, small, documents):
    got = collected(sharding.run(spark, small))
    assert len(got) == len(documents)
    texts = {r[0]: (r[1] or "").encode() for r in documents}
    for r in got:
        assert (r["size"], r["text_crc32"], r["law"]) == (len(texts[r["doc_id"]]) + 1, zlib.crc32(texts[r["doc_id"]]), "key")
        assert r["grown_shard"] in (r["shard"], 16)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_follow_weights_and_move_little(spark):
    rows = spark.range(40_000).withColumnRenamed("id", "doc_id")
    three = sharding.assign_shards(rows, "doc_id", [1.0, 2.0, 1.0])
    both = sharding.assign_shards(three, "doc_id", [1.0, 2.0, 0.0], "less")
    counts = {r[0]: r[1] for r in both.groupBy("shard").count().collect()}
    assert abs(counts[1] - 20_000) < 600 and abs(counts[0] - 10_000) < 600
    assert both.where("shard <> 2 AND shard <> less").count() == 0


@pytest.mark.parametrize("where", ["small", "given"])
def test_jaccard_join_against_all_pairs(spark, small, documents, where):
    folder = small if where == "small" else GIVEN
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = collected(jaccard_join.run(spark, folder))
    assert len(got) == len(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == jaccard_join.brute_force(rows)


def test_one_of_each_keeps_the_smallest_id(spark, small, documents):
    want = jaccard_join.brute_force([r[:2] for r in documents])
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = [r["doc_id"] for r in jaccard_join.one_of_each(docs).collect()]
    assert sorted(kept) == sorted({c for _, c in want.values()})


def test_host_verdicts_shrink_small_hosts(spark):
    rows = spark.createDataFrame([("bad", True)] * 80 + [("bad", False)] * 20 + [("good", False)] * 300 + [("tiny", True)] + [(None, False)],
                                 "host string, failed boolean")
    got = {r["_host"]: r for r in quality_rules.host_verdicts(rows, "host", "failed").collect()}
    assert not got["bad"]["host_kept"] and got["good"]["host_kept"] and got[None]["host_kept"]
    assert got["tiny"]["host_rate"] < 1


def test_license_scan(spark):
    found = license_scan.run(spark, GIVEN)
    got = {(r["doc_id"], r["paragraph"]) for r in found.collect()}
    texts = spark.read.parquet(f"{GIVEN}/documents.parquet").collect()
    assert got == {(d["doc_id"], i) for d in texts for i, l in enumerate((d["text"] or "").split("\n")) if "icense" in l}


@pytest.mark.parametrize("text", [None, "", "word " * 50_000])
def test_license_scan_of_plain_texts(spark, text):
    assert license_scan.scan_licenses(spark.createDataFrame([(1, text), (1, text), (None, text)], "doc_id long, text string")).count() == 0


def test_url_filter_longest_rule_wins(spark, small):
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.run(spark, small).collect()}
    assert got[0] == ("", "", None, "allow")
    assert got[3] == ("a.example.org", "/en/12", "example.org/en/1", "block")
    assert got[5] == ("example.org", "/es", "org/", "allow")
    assert got[7][2:] == ("org/", "allow") and got[9][2:] == ("com/de/", "block") and got[11][2:] == (None, "allow")


@pytest.mark.parametrize("where", ["small", "given"])
def test_multi_index_recall(spark, small, where):
    folder = small if where == "small" else GIVEN
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()
    good = {r[0]: np.array(r[1], dtype=float) for r in rows if r[1] is not None and None not in r[1]}
    good = {i: v for i, v in good.items() if np.isfinite(v).all() and v.any()}
    ids = np.array(sorted(good))
    x = np.array([good[i] / np.linalg.norm(good[i]) for i in ids])
    got = defaultdict(list)
    for r in sorted(multi_index.run(spark, folder).collect(), key=lambda r: r["rank"]):
        got[r["query_id"]].append(r)
    queries = [i for i in ids if i % 50 == 0]
    assert sorted(got) == queries
    hits = 0
    for q in queries:
        score = x @ (good[q] / np.linalg.norm(good[q]))
        want = [i for _, i in sorted((-s, i) for s, i in zip(score, ids) if i != q)[:5]]
        hits += len({r["vec_id"] for r in got[q]} & set(want))
        assert [r["rank"] for r in got[q]] == [1, 2, 3, 4, 5]
        assert all(abs(r["score"] - score[np.searchsorted(ids, r["vec_id"])]) < 1e-9 for r in got[q])
    assert hits >= 0.9 * 5 * len(queries)


@pytest.mark.parametrize("where", ["small", "given"])
def test_byte_bpe_agrees_with_the_published_library(spark, small, where):
    import tiktoken
    folder = small if where == "small" else GIVEN
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    model = tiktoken.Encoding("check", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r[0]: r[1] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    for r in byte_bpe.run(spark, folder).collect():
        ids = model.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def held_out_accuracy(scored, labels):
    """Share of the held out labelled rows that are predicted right."""
    known = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    right = scored.where("held_out").join(known, "doc_id").agg(F.avg((F.col("quality") == F.col("predicted")).cast("double")))
    return right.first()[0]


def test_quality_classifier(spark, small, documents):
    scored = quality_classifier.run(spark, GIVEN)
    assert held_out_accuracy(scored, spark.read.parquet(f"{GIVEN}/labels.parquet")) > 0.7
    got = collected(quality_classifier.run(spark, small))
    assert len(got) == len(documents)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)


@pytest.mark.parametrize("where", ["small", "given"])
def test_packing(spark, small, where):
    from tokenizers import Tokenizer
    folder = small if where == "small" else GIVEN
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    want = Counter()
    for doc, text in rows:
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 0]
        for p, s in enumerate(range(0, len(ids), 2048)):
            part = ids[s:s + 2048]
            want[doc, p, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    got = collected(packing.run(spark, folder))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        assert all(o == e for (o, _), e in zip(sorted(b), [0, *np.cumsum([n for _, n in sorted(b)])], strict=False))
        assert sum(n for _, n in b) <= 2048 and sum(n > 2048 // 3 for _, n in b) <= 2
    total = sum(r["length"] for r in got)
    assert len(bins) <= 1.1 * -(-total // 2048) + 1


@pytest.mark.parametrize("name", sorted(llm_queries()))
def test_empty_tables_give_empty_results(spark, empty, name):
    assert llm_queries()[name][0](spark, empty).count() == 0


def test_pipeline_stages(spark, small, documents):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    scores = {r["doc_id"]: r["predicted"] for r in quality_classifier.run(spark, small).collect()}
    good = corpus_pipeline.good_quality(spark, docs, small)
    assert good.columns == columns
    assert sorted(r["doc_id"] for r in good.collect()) == sorted(r[0] for r in documents if scores[r[0]])
    ruled = corpus_pipeline.host_rules(spark, docs, small)
    kept = {r["doc_id"] for r in quality_rules.run(spark, small).where("kept").collect()}
    assert ruled.columns == columns and {r["doc_id"] for r in ruled.collect()} == kept
    lines = corpus_pipeline.without_repeated_lines(spark, docs, small)
    want = {d: t for d, (n, t) in plain_line_dedup([r[:2] for r in documents]).items() if not n or (t or "").strip(" \t\n\x0b\x0c\r")}
    assert lines.columns == columns and {r["doc_id"]: r["text"] for r in lines.collect()} == want
    one = corpus_pipeline.one_of_each_group(spark, docs, small)
    assert one.columns == columns and one.count() == len({c for _, c in jaccard_join.brute_force([r[:2] for r in documents]).values()})


@pytest.mark.parametrize("where", ["small", "empty"])
def test_pipeline_runs(spark, request, where):
    got = corpus_pipeline.run(spark, request.getfixturevalue(where))
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(got.columns)
    assert got.count() >= 0


def test_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (4, "a b c d e f"), (None, None)], "doc_id long, text string")
    assert line_dedup.dedup_lines(docs).count() == 4
    assert sorted((r["component_id"] is None, r["component_id"] or 0) for r in jaccard_join.similar_documents(docs).collect()) == [
        (False, 4), (False, 4), (False, 4), (True, 0)]
    assert packing.pack_documents(docs).count() == 4
    assert quality_rules.host_rules(docs.withColumn("source", F.lit(None).cast("string")), ["doc_id"]).count() == 4
    assert byte_bpe.encode_texts(docs, ["doc_id"]).count() == 4
