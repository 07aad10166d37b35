"""Packing of token sequences: pairs of large pieces first, then best fit for the small ones.

Texts become token ids (a cache of words per Python worker in front of the tokenizer, until the worker serves another
operator), each closed by a separator; documents beyond the capacity are cut. What goes with what is planned on the
counts of pieces by length, at most one row for each length up to the capacity, so the plan's size
depends on the capacity alone. Pieces above a third of the capacity are matched greedily, the
longest with the longest that still fits, at most two in a sequence; shorter pieces, longest first,
go to the smallest gap that holds them. The plan gives runs of pieces to runs of sequences; pieces
of one length are numbered in parts (``gapless``) and look up their place. No task sees a whole length.

Defined results: a null or empty text has the separator alone. Repeated rows are packed each by itself.
Null ids are carried. An empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vialume.llm.common import gapless, keep_only, stored, table, worker_cache

QUERY = "op10_best_fit_packing"
CAPACITY = 2048
SEPARATOR = 0
#: Words remembered by a Python worker; beyond that only those in use stay.
REMEMBERED = 800_000
PLAN = "length long, rank_from long, rank_to long, bin_from long, bins long, place long"

_known: dict[str, dict[str, bytes]] = worker_cache()
_loaded: dict[str, object] = worker_cache()
#: The tokenizer splits at all of these at least, so words between them can be encoded alone.
_RUNS = re.compile(r"[^ \t\n\r]+")
#: Texts without other characters need no composition, and lower case means the same to Python and tokenizer.
_OTHER = re.compile("[^\x00-\u012f\u0131-\u024f]")
_LETTER = "[a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u024f]"
_MARK = r"[,.!?;:*&%$#|()\-]"
#: In those, the tokenizer also splits a run of letters from the marks after it at the end of a word.
_PARTS = re.compile(rf"{_LETTER}+(?={_MARK}*(?:[ \t\n\r]|\Z))|{_MARK}+(?=[ \t\n\r]|\Z)|[^ \t\n\r]+")


#: The vocabulary writes bytes as letters: those without a visible sign follow from U+0100 on.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}


#: The steps of the tokenizer file that the words below were cut for.
_STEPS = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, "<u4").tobytes()


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode_texts(texts: list[str | None], tokenizer: str) -> Iterator[bytes]:
    """Ids of each text as little-endian 32-bit numbers, without the separator.

    Words are encoded once each where the file has the steps of ``_STEPS``; any other file encodes whole texts.
    """
    from tokenizers import Tokenizer

    if tokenizer not in _loaded:
        model = Tokenizer.from_file(tokenizer)
        steps = json.loads(model.to_str())
        _loaded[tokenizer] = model, {k: steps[k] for k in _STEPS} == _STEPS
    (model, by_word), known = _loaded[tokenizer], _known.setdefault(tokenizer, {})
    if not by_word:
        for e in model.encode_batch_fast([t or "" for t in texts], add_special_tokens=False):
            yield _packed(e.ids)
        return
    split = [_RUNS.findall(t) if _OTHER.search(t) else _PARTS.findall(t.lower()) for t in (t or "" for t in texts)]
    every = set().union(*split)
    if new := [w for w in every if w not in known]:
        if len(known) + len(new) > REMEMBERED:
            kept = {w: known[w] for w in every if w in known}
            known.clear()
            known.update(kept)
        rest, merge = [], model.model.tokenize
        for w in new:
            if w.isalpha() and w.islower() and not _OTHER.search(w):  # one run of letters: only the merges are left to do
                known[w] = _packed([t.id for t in merge(w if w.isascii() else w.encode().decode("latin-1").translate(_BYTES))])
            else:
                rest.append(w)
        for at in range(0, len(rest), 10_000):
            part = rest[at:at + 10_000]
            for w, e in zip(part, model.encode_batch_fast(part, add_special_tokens=False), strict=True):
                known[w] = _packed(e.ids)
    for words in split:
        yield b"".join(map(known.__getitem__, words))


def begin() -> None:
    keep_only(_known, _loaded)


def token_pieces(docs: DataFrame, doc_id: str = "doc_id", tokenizer: str | None = None,
                 capacity: int = CAPACITY, separator: int = SEPARATOR) -> DataFrame:
    """Pieces of at most ``capacity`` ids: doc_id, piece, start, length and checksum of the ids."""
    path = tokenizer or default_tokenizer()
    end = np.array([separator], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = []
                for doc, ids in zip(part.column(0).to_pylist(), encode_texts(part.column(1).to_pylist(), path), strict=True):
                    ids += end
                    for n, start in enumerate(range(0, len(ids), 4 * capacity)):
                        piece = ids[start:start + 4 * capacity]
                        rows.append((doc, n, start // 4, len(piece) // 4, zlib.crc32(piece)))
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                                 names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(doc_id).cast("long"), "text").mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, rank_from, rank_to, bin_from, bins, place).

    Piece r of a length, with rank_from <= r < rank_to, goes to sequence bin_from + (r - rank_from) % bins,
    at place + length * ((r - rank_from) // bins).
    """
    left, used, plan, bins = dict(counts), defaultdict(int), [], 0
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> runs (first sequence, how many)

    def put(length: int, first: int, k: int, place: int, levels: int = 1) -> None:
        plan.append((length, used[length], used[length] + k * levels, first, k, place))
        used[length] += k * levels
        left[length] -= k * levels

    large = sorted((n for n, c in left.items() if 3 * n > capacity and c), reverse=True)
    for a in large:
        for b in (n for n in large if n <= min(a, capacity - a)):
            k = left[a] // 2 if a == b else min(left[a], left[b])
            if k:
                put(a, bins, k, 0)
                put(b, bins, k, a)
                heappush(gaps[capacity - a - b], (bins, k))
                bins += k
        if k := left[a]:
            put(a, bins, k, 0)
            heappush(gaps[capacity - a], (bins, k))
            bins += k
    for n in sorted((n for n, c in left.items() if 3 * n <= capacity and c), reverse=True):
        sizes = sorted(g for g, runs in gaps.items() if g >= n and runs)
        while left[n]:
            if sizes:
                gap = sizes[0]
                first, k = heappop(gaps[gap])  # of equal gaps the first sequence
                if not gaps[gap]:
                    sizes.pop(0)
                place = capacity - gap
            else:
                gap, place, first, k = capacity, 0, bins, -(-left[n] // (capacity // n))
                bins += k
            each = gap // n  # one sequence after another is filled: what is left of its gap is the smallest that holds the next piece
            full = min(k, left[n] // each)
            if full:
                put(n, first, full, place, each)
                heappush(gaps[gap - each * n], (first, full))
            if full < k:
                if some := left[n]:
                    put(n, first + full, 1, place, some)
                    heappush(gaps[gap - some * n], (first + full, 1))
                    full += 1
                if full < k:
                    heappush(gaps[gap], (first + full, k - full))
    return plan


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (from a stored table, as it is read twice) with sequence_id and offset."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = F.broadcast(spark.createDataFrame(plan_packing(counts, capacity), PLAN).withColumnRenamed("length", "_length"))
    ranked = gapless(pieces, ["length"], ["doc_id", "piece", "ids_crc32"], "_rank")
    at = F.col("_rank") - F.col("rank_from")
    return ranked.join(plan, (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("rank_from"))
                       & (F.col("_rank") < F.col("rank_to"))).select(
        *pieces.columns, (F.col("bin_from") + at % F.col("bins")).alias("sequence_id"),
        (F.col("place") + F.col("length") * F.floor(at / F.col("bins"))).alias("offset"))


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """All pieces of ``docs`` with their sequence and place in it."""
    return place_pieces(stored(token_pieces(docs, doc_id, tokenizer, capacity), "pieces"), capacity)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


SQL = None  # no SQL engine has the tokenizer; tests/llm checks ids, gaps and the plan
