"""Clashing names, long texts, and plain versions of the draws and scores."""

import math
import random
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from vialume.llm import (byte_bpe, jaccard_join, license_scan, line_dedup, multi_index, packing, quality_classifier, quality_rules, sharding,
                         substring_dedup)
from vialume.session import shared_dir

GIVEN = "/root/testdata/sf0.001"
NAMES = ["_of", "_text", "host", "row", "n_words", "kept", "ids", "decoded", "rid", "th", "set", "n", "score", "size", "_fold", "_host", "covered"]


@pytest.fixture
def clashing(spark, small):
    """The awkward documents with columns named like the operators' own."""
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    return docs.withColumns({n: F.lit("own") for n in NAMES})


def test_columns_of_the_caller_are_kept(clashing, documents):
    n = len(documents)
    ruled = quality_rules.host_rules(clashing, ["doc_id", *NAMES])
    assert ruled.columns.count("kept") == 1 and ruled.count() == n
    assert ruled.where("_of = 'own' AND host = 'own' AND _text = 'own'").count() == n
    coded = byte_bpe.encode_texts(clashing, ["doc_id", *NAMES])
    assert coded.columns.count("ids") == 1 and coded.where("row = 'own' AND _text = 'own'").count() == n
    assert line_dedup.dedup_lines(clashing).where("rid = 'own' AND covered = 'own'").count() == n
    assert substring_dedup.dedup_passages(clashing).where("rid = 'own' AND row = 'own'").count() == n
    scored = quality_classifier.score(clashing, {"dictionaries": (b"", b""), "weights": [0.0, 0.0, 0.0]}, "_score")
    assert scored.where("score = 'own' AND _score = 0.5").count() == n
    assert jaccard_join.similar_documents(clashing).count() == n
    assert packing.pack_documents(clashing).select("doc_id").distinct().count() == len({r[0] for r in documents})
    assert sharding.assign_shards(clashing, "doc_id", [1.0, 1.0]).where("n = 'own'").count() == n


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_columns_with_any_name(spark, small, clashing, stage):
    name, function = corpus_pipeline.STAGES[stage]
    plain = clashing.select("doc_id", "text", "lang", "source", "n_chars")
    got, want = (function(spark, docs, small) for docs in (clashing, plain))
    assert got.columns == want.columns
    ids = [c for c in ("doc_id", "text", "piece", "length") if c in got.columns]
    assert sorted(map(tuple, got.select(*ids).collect()), key=repr) == sorted(map(tuple, want.select(*ids).collect()), key=repr)


def test_stored_ids_are_decoded(spark, documents):
    docs = spark.createDataFrame([(r[0], r[1], "own") for r in documents], "doc_id long, text string, decoded string")
    ids = byte_bpe.encode_texts(docs, ["doc_id", "text"]).select("doc_id", "text", "ids")
    back = byte_bpe.decode_texts(ids, name="again")
    assert all(bytes(r["again"]) == (r["text"] or "").encode() for r in back.collect())
    none = byte_bpe.decode_texts(spark.createDataFrame([(None,), ("",)], "ids string"))
    assert [bytes(r["decoded"]) for r in none.collect()] == [b"", b""]


def test_words_of_many_lengths_are_encoded_together(monkeypatch):
    import public_tokenizers
    import tiktoken
    monkeypatch.setattr(byte_bpe, "ROUNDS_ROWS", 3000)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    pick = random.Random(4)
    texts = ["".join(pick.choice("aeioustrn") for _ in range(n)) for n in [*range(1, 60), 200, 255, 256, 257, 300, 2000]]
    model = tiktoken.Encoding("check", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    found = list(byte_bpe.Codec(path, public_tokenizers.PATTERN).encode(texts))
    assert [f[0] for f in found] == [" ".join(map(str, model.encode_ordinary(t))) for t in texts]
    assert [f[1] for f in found] == [t.encode() for t in texts]


def test_the_draw_of_a_shard(spark):
    """Rendezvous hashing again, with a published hash."""
    weights = [1.0, 0.5, 3.0, 0.0]

    def drawn(key):
        seed = xxhash.xxh64_intdigest(key.encode(), 42)
        bits = [xxhash.xxh64_intdigest(s.to_bytes(4, "little"), seed) >> 11 for s in range(4)]
        draws = [math.log((b + 0.5) / 2**53) / w if w else -math.inf for b, w in zip(bits, weights)]
        return max(range(4), key=draws.__getitem__)

    rows = spark.createDataFrame([(str(i),) for i in range(500)] + [(None,)], "doc_id string")
    got = {r["doc_id"]: r["shard"] for r in sharding.assign_shards(rows, "doc_id", weights).collect()}
    assert got == {k: drawn(k or "") for k in got}


def test_scores_follow_from_the_compressed_sizes(spark):
    """The score again from zstandard itself, also of a very long text."""
    import zstandard
    good, bad = b"a plain sentence about the weather. " * 40, b"#### buy $$$ now >>> " * 60
    weights = [0.1, 30.0, -2.0]
    texts = [None, "", "a plain sentence", "buy $$$ now", "the weather, " * 100_000]

    def size(block, data):
        held = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=3)
        return len(zstandard.ZstdCompressor(dict_data=held, level=3, write_content_size=False, write_checksum=False, write_dict_id=False).compress(block))

    def score(text):
        data = (text or "").encode()
        pairs = [(size(data[i:i + 2048], bad), size(data[i:i + 2048], good)) for i in range(0, len(data), 2048)]
        n = max(1, len(data))
        z = weights[0] + weights[1] * sum(b - g for b, g in pairs) / n + weights[2] * sum(map(min, pairs)) / n
        return 1 / (1 + math.exp(-z))

    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in quality_classifier.score(rows, {"dictionaries": (bad, good), "weights": weights}).collect()}
    assert all(abs(got[i] - score(t)) < 1e-9 for i, t in enumerate(texts))


def test_pieces_of_a_long_text_reach_its_end():
    data = bytes(range(256)) * 100
    pieces = quality_classifier.spread_pieces(data, 1024)
    assert len(pieces) == 1024 and pieces.startswith(data[:256]) and pieces.endswith(data[-256:])
    assert quality_classifier.spread_pieces(data, len(data)) == data
    assert quality_classifier.spread_pieces(b"", 512) == b""


def test_smallest_hashes_do_not_depend_on_partitions(spark):
    from vialume.llm.common import smallest_hashes
    rows = spark.range(30_000).withColumnRenamed("id", "doc_id")
    got = [[r[0] for r in smallest_hashes(rows.repartition(n), ["doc_id"], 50).collect()] for n in (1, 7)]
    want = [r[0] for r in rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(50).collect()]
    assert got == [want, want] and smallest_hashes(rows.limit(3), ["doc_id"], 50).count() == 3


def test_families_of_planted_notices(spark):
    """Every family's first notice is found as that family among lines that are none, and the lines are left alone."""
    pick = random.Random(2)
    lines = [" ".join(pick.choice(["river", "stone", "walked", "over", "the", "old", "bridge", "and", "sang"]) for _ in range(9)) for _ in range(300)]
    rows = [(i, "\n".join([lines[i], notices[0], lines[i + 50]])) for i, notices in enumerate(license_scan.NOTICES.values())]
    rows += [(1000 + i, line) for i, line in enumerate(lines)] + [(2000 + i, d) for i, d in enumerate(license_scan.DECOYS)]
    rows.append((5000, "word " * 50_000))
    found = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["paragraph"], r["family"]) for r in found} == {(i, 1, f) for i, f in enumerate(license_scan.NOTICES)}


@pytest.mark.parametrize(("n", "groups"), [(2000, None), (20_000, None), (20_000, 400)])
def test_recall_where_the_index_prunes(spark, n, groups):
    """Recall of at least 0.9 with half of the rows compared: vectors without any structure, and in groups."""
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, 64))
    if groups:
        x = rng.normal(size=(groups, 64))[rng.integers(0, groups, n)] + 0.4 * x
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x.astype(np.float32))], "vec_id long, embedding array<float>")
    found = multi_index.search(rows, F.col("vec_id") % 100 == 0)
    got = {(r["query_id"], r["vec_id"]) for r in found.collect()}
    u = x.astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1)[:, None]
    want = set()
    for q in range(0, n, 100):
        s = u @ u[q]
        s[q] = -2
        want |= {(q, int(i)) for i in np.argsort(-s)[:5]}
    assert len(got & want) >= 0.9 * len(want)


def test_sets_that_share_half_of_their_name_stay_apart(spark, small, documents, monkeypatch):
    """As if every first half were shared by different sets: the second halves name them then."""
    whole = jaccard_join.set_names
    monkeypatch.setattr(jaccard_join, "shared_names", lambda sets: frozenset(r[0] for r in sets.where("n > 0").select("set").distinct().collect()))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.run(spark, small).collect()}
    assert got == jaccard_join.brute_force([r[:2] for r in documents])
    a = np.array([1, 2, 3], np.uint64)
    assert jaccard_join.set_id(a) == whole(a)[0] and jaccard_join.set_id(a, frozenset([whole(a)[0]])) == whole(a)[1] != whole(a)[0]


def test_batches_are_cut_by_bytes(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(jaccard_join, "READ_BYTES", 10)
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(["a" * 4, None, "b" * 30, "", "c" * 6, "d" * 3, "e"])], names=["i", "t"])
    parts = list(jaccard_join.by_bytes([batch, batch.slice(0, 0)], 1))
    assert [x for p in parts for x in p.column(0).to_pylist()] == list(range(7)) and len(parts) > 2


def test_few_texts_but_the_wanted_ones_are_shuffled(spark, monkeypatch):
    """The sieve loses no wanted document, with or without an id; a full sieve changes the work, not the sets."""
    texts = [(i, f"some five words and {i}") for i in range(2000)] + [(None, "a text without an id"), (None, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    wanted = [*range(0, 2000, 100), None]
    names = spark.createDataFrame([(i, f"some five words and {i}" if i is not None else "a text without an id") for i in wanted], "doc_id long, text string")
    named = jaccard_join.read_sets(names).where("n > 0").select("set", "doc_id")
    passed, sets = [], []
    for words in (1 << 20, 1):
        monkeypatch.setattr(jaccard_join, "SIEVE_WORDS", words)
        passed.append([r["doc_id"] for r in jaccard_join.sieved(docs, named.withColumnRenamed("doc_id", "_named")).collect()])
        sets.append(sorted((r["set"], r["shingles"]) for r in jaccard_join.full_sets(docs, named, named.select("set")).collect()))
    assert set(wanted) <= set(passed[0]) and len(passed[0]) < 400 and set(wanted) <= set(passed[1])
    assert len(sets[0]) == len(wanted) and sets[0] == sets[1]
    assert jaccard_join.sieved(docs, named.withColumnRenamed("doc_id", "_named").limit(0)).count() == 0


def test_the_first_shingles_are_removed_when_the_members_are_stored(spark, small):
    shared = Path(shared_dir(spark).removeprefix("file://"))
    before = set(shared.iterdir())
    jaccard_join.linked_sets(spark.read.parquet(f"{small}/documents.parquet"))
    found = sorted(p.name.split("-")[1] for p in set(shared.iterdir()) - before)
    assert "prefixes" not in found and found.count("members") == 1


def test_a_family_of_texts_sends_few_points(spark, monkeypatch):
    """Twelve texts that share passages are in very many trees, with links and without; their points are sent a few times."""
    pick = random.Random(5)
    passages = [" ".join(f"w{pick.randrange(10**6)}" for _ in range(12)) for _ in range(40)]
    rows = [(i, " ".join(passages[k] for k in sorted(pick.sample(range(40), 28)))) for i in range(12)]
    rows += [(20 + i, rows[3][1].rsplit(" ", i)[0]) for i in range(1, 4)] + [(30, rows[0][1])]
    sent, whole = [], jaccard_join.in_tiles

    def counted(members, *rest):
        sent.append(members.count())
        return whole(members, *rest)

    monkeypatch.setattr(jaccard_join, "in_tiles", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.similar_documents(docs).collect()}
    assert got == jaccard_join.brute_force(rows) and len({c for _, c in got.values()}) == 12
    assert sent[0] < 150


def test_merged_trees_keep_every_pair(spark):
    """Trees of one smallest set are one only where that makes no more pairs; every pair of members still meets."""
    pick = random.Random(6)
    family = [sorted(pick.sample(range(8), 6)) for _ in range(30)]
    loose = [[100, 200 + 3 * i, 201 + 3 * i] for i in range(20)]
    rows = [(t, s, s) for t, members in enumerate(family + loose) for s in members]
    trees = [(t, len(m), m[0]) for t, m in enumerate(family + loose)]
    members = spark.createDataFrame(rows, "tree long, set long, component long")
    got = jaccard_join.merged_trees(members, spark.createDataFrame(trees, "tree long, n long, first long")).collect()
    found = {}
    for r in got:
        found.setdefault(r["tree"], set()).add(r["set"])
    assert len(got) == sum(map(len, found.values())) < 6 * 8 + 20 * 3 + 1
    assert all(any(set(m) <= f for f in found.values()) for m in family + loose)
    assert sum(100 in f for f in found.values()) == 20


@pytest.mark.parametrize(("n", "m", "groups"), [(1, 1, 128), (700, 512, 128), (40, 300, 8), (33, 1000, 16)])
def test_trees_find_every_pair_within_the_bound(n, m, groups):
    """The walk gives exactly the pairs that the bound and the sizes let pass, each once."""
    rng = np.random.default_rng(n * m)
    hearts = rng.poisson(3, (12, groups))
    points = np.maximum(0, hearts[rng.integers(0, 12, n + m)] + rng.integers(-1, 2, (n + m, groups))).astype(np.int32)
    sizes = points.sum(axis=1)
    left, right = np.arange(n), np.arange(n, n + m)
    got = [(int(x), int(y)) for i, j in jaccard_join.tree_pairs(points, sizes, left, right) for x, y in zip(i, j)]
    bound = np.array([np.minimum(points[x], points[right]).sum(axis=1) for x in left])
    a, b = sizes[left][:, None], sizes[right][None, :]
    x, y = np.nonzero((bound >= jaccard_join.needed(a, b)) & (5 * np.minimum(a, b) >= 4 * np.maximum(a, b)))
    assert len(got) == len(set(got)) and set(got) == set(zip(left[x].tolist(), right[y].tolist()))


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_packing_takes_any_tokenizer_file(documents, name):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path(name)
    model = Tokenizer.from_file(path)
    texts = [r[1] for r in documents] + ["It's  HER\u00c9'S 12 ab12", "\u0130stanbul \u1e9e x"]
    got = [np.frombuffer(ids, "<u4").tolist() for ids in packing.encode_texts(texts, path)]
    assert got == [model.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert packing._loaded[path][1] == (name == "word_bpe_49k.json")


@pytest.mark.parametrize("make", [
    jaccard_join.read_sets, lambda docs: jaccard_join.prefixes(docs, np.zeros(0, np.uint64)),
    lambda docs: quality_rules.count_texts(docs, ["doc_id"], "source"),
    lambda docs: quality_classifier.score(docs, {"dictionaries": (b"bad", b"good"), "weights": [0.0, 1.0, 1.0]})])
def test_workers_drop_what_packing_remembered(clashing, make, monkeypatch):
    """Workers serve one operator after another: words and tokenizer would stay beside the memory of the next."""
    import public_tokenizers
    path, taken = public_tokenizers.path("word_bpe_49k.json"), []
    monkeypatch.setattr(type(clashing), "mapInArrow", lambda self, f, schema: taken.append((self, f)) or self)
    make(clashing)
    rows, f = taken[-1]
    list(packing.encode_texts(["some words"], path))
    packing.begin()  # the tasks of one operator share them
    assert {"some", "words"} <= packing._known[path].keys() and path in packing._loaded
    assert sum(b.num_rows for b in f(iter(rows.toArrow().to_batches())))
    assert not packing._known and not packing._loaded


def plain_bins(pieces, capacity):
    """Greedy pairs of large pieces and best fit of small ones, a piece at a time; the lengths in each sequence."""
    left, bins = sorted((n for n in pieces if 3 * n > capacity), reverse=True), []
    while left:
        a = left.pop(0)
        b = next((n for n in left if n <= capacity - a), None)
        if b is not None:
            left.remove(b)
        bins.append([a] if b is None else [a, b])
    for n in sorted((n for n in pieces if 3 * n <= capacity), reverse=True):
        fits = [b for b in bins if capacity - sum(b) >= n]
        if fits:
            min(fits, key=lambda b: capacity - sum(b)).append(n)
        else:
            bins.append([n])
    return sorted(sorted(b) for b in bins)


@pytest.mark.parametrize("seed", range(12))
def test_the_plan_is_that_of_one_piece_at_a_time(seed):
    """The plan on counts by length gives the sequences that a plain matching gives, and places without gaps or overlaps."""
    pick = random.Random(seed)
    capacity = pick.choice([12, 30, 64, 100])
    lengths = [pick.randint(1, capacity) for _ in range(pick.randint(1, 9))]
    pieces = [pick.choice(lengths) for _ in range(pick.randint(1, 400))]
    counts = {n: pieces.count(n) for n in set(pieces)}
    bins = {}
    for length, low, high, first, k, place in packing.plan_packing(counts, capacity):
        for r in range(low, high):
            bins.setdefault(first + (r - low) % k, []).append((place + length * ((r - low) // k), length))
    for of in bins.values():
        ends = 0
        for place, length in sorted(of):
            assert place == ends
            ends += length
        assert ends <= capacity
    assert sorted(sorted(n for _, n in of) for of in bins.values()) == plain_bins(pieces, capacity)
