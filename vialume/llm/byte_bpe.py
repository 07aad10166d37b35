"""Byte-level BPE by recursive SQL inside the tasks.

Texts are split by the tokenizer's pattern; each task keeps the distinct words it has met and gives new ones, many
at a time, to an in-memory DuckDB. There a word is rows of (position, token). A recursive query joins
neighbouring tokens with the merge table, contracts the leftmost pair of minimum rank of every word, and ends when
no pair is left. Each text's ids are decoded again by looking them up in order; ``decode_texts`` decodes stored ids by
joining them with the vocabulary and aggregating the bytes in order.

The merge table holds every split of a vocabulary entry into two entries, as the published encoder ranks
a pair by the bytes it makes. A word that is an entry itself needs no merge. A word of more than
``LONG`` bytes would take a round for each merge, so it goes through a heap of the same pairs.

Defined results: a null or empty text has no ids; the hashes are then those of nothing. White space and any
other characters are encoded, so decoding gives the bytes back. Repeated rows are encoded each by itself. Other columns
are kept, whatever their names, but for those named like a result, which are replaced.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
import tempfile
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vialume.llm.common import table

QUERY = "op8_byte_bpe"
LONG = 256
#: Words a process remembers; beyond that only those in use stay.
REMEMBERED = 600_000
#: Squared word lengths, so rows of the recursive table, that go through one query.
ROUNDS_ROWS = 2_000_000
#: Characters that are split before their new words are encoded together.
TOGETHER = 6_000_000

#: A row is a token with the place and token that follow it and what both make together, if anything.
#: ``best`` has one row for each word that is not done: its leftmost pair of minimum rank (place and
#: follower fit into 10 bits each, as words have at most LONG bytes) and what follows that pair.
ENCODE = """
WITH RECURSIVE state AS (
  SELECT l.word, l.pos, l.token, l.fpos, l.ftoken, m.merged, 0 AS step
  FROM letters l LEFT JOIN merges m ON l.token = m.first AND l.ftoken = m.second
  UNION ALL
  (WITH best AS (
    SELECT b.word, b.pair >> 20 AS merged, (b.pair >> 10) & 1023 AS pos, b.pair & 1023 AS fpos, q.fpos AS nfpos, q.ftoken AS nftoken
    FROM (SELECT word, min((CAST(merged AS BIGINT) << 20) + (pos << 10) + fpos) AS pair FROM state WHERE merged IS NOT NULL GROUP BY word) b
    JOIN state q ON q.word = b.word AND q.pos = b.pair & 1023)
  SELECT n.word, n.pos, n.token, n.fpos, n.ftoken, m.merged, n.step
  FROM (SELECT s.word, s.pos, CAST(CASE WHEN s.pos = b.pos THEN b.merged ELSE s.token END AS INT) AS token,
          CASE WHEN s.pos = b.pos THEN b.nfpos ELSE s.fpos END AS fpos,
          CAST(CASE WHEN s.pos = b.pos THEN b.nftoken WHEN s.fpos = b.pos THEN b.merged ELSE s.ftoken END AS INT) AS ftoken,
          s.step + 1 AS step
        FROM state s JOIN best b ON s.word = b.word WHERE s.pos <> b.fpos) n
  LEFT JOIN merges m ON n.token = m.first AND n.ftoken = m.second)
),
done AS (SELECT s.word, s.pos, s.token FROM state s JOIN (SELECT word, max(step) AS step FROM state GROUP BY word) e ON s.word = e.word AND s.step = e.step)
SELECT word, string_agg(token, ' ' ORDER BY pos) AS ids, list(token ORDER BY pos) AS tokens FROM done GROUP BY word
"""
DECODE = """
SELECT d.id, coalesce(string_agg(v.bytes, '' ORDER BY d.pos), '') AS bytes
FROM (SELECT id, unnest(ids) AS token, unnest(range(len(ids))) AS pos FROM sequences) d JOIN vocabulary v ON v.token = d.token
GROUP BY d.id
"""


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


class Codec:
    """Encoder and decoder of one process."""

    def __init__(self, ranks_path: str, pattern: str):
        self.ranks = read_ranks(ranks_path)
        by_rank = {r: t for t, r in self.ranks.items()}
        every = [by_rank.get(r, b"") for r in range(max(by_rank) + 1)]
        self.lengths = np.array([len(t) for t in every], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.letters_of = np.frombuffer(b"".join(every), np.uint8)
        self.letters = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.split = regex.compile(pattern).findall
        self.words: dict[str, tuple[str, bytes]] = {}
        self.db = duckdb.connect(config={"threads": "1", "memory_limit": "300MB", "temp_directory": tempfile.mkdtemp(prefix="byte-bpe-")})
        pairs = [(self.ranks[t[:i]], self.ranks[t[i:]], r) for t, r in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        merges = pa.table({c: pa.array(v, pa.int32()) for c, v in zip(("first", "second", "merged"), zip(*pairs, strict=True), strict=True)})
        vocabulary = pa.table({"token": pa.array(list(self.ranks.values()), pa.int32()), "bytes": pa.array([t.hex() for t in self.ranks])})
        for name, rows in (("merges", merges), ("vocabulary", vocabulary)):
            self.db.register("given", rows)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")

    def merge_long(self, word: bytes) -> list[int]:
        """The same contraction for one long word: pairs in a heap by rank, then place."""
        n = len(word)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # end of the token that begins here; where the one before begins
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := self.ranks.get(word[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            middle = end[i]
            if middle is None or middle >= n or end[middle] != stop or middle == stop:
                continue
            end[i], end[middle] = stop, None
            if stop < n:
                before[stop] = i
                if (r := self.ranks.get(word[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (p := before[i]) >= 0 and (r := self.ranks.get(word[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[word[i:end[i]]])
            i = end[i]
        return ids

    def encode_words(self, words: list[bytes]) -> list[tuple[str, bytes]]:
        """Ids of each word, as decimals joined by spaces and as 32-bit numbers."""
        out, rest = [("", b"")] * len(words), []
        for i, word in enumerate(words):
            if (rank := self.ranks.get(word)) is not None:
                out[i] = (str(rank), rank.to_bytes(4, sys.byteorder))
            elif len(word) > LONG:
                ids = self.merge_long(word)
                out[i] = (" ".join(map(str, ids)), np.array(ids, np.int32).tobytes())
            elif word:
                rest.append(i)
        work = np.cumsum([len(words[i]) ** 2 for i in rest])  # the recursive table keeps every round
        cuts = [0, *np.searchsorted(work, np.arange(ROUNDS_ROWS, work[-1] if len(work) else 0, ROUNDS_ROWS)).tolist(), len(rest)]
        for at, stop in zip(cuts, cuts[1:], strict=False):
            if at == stop:
                continue
            part = rest[at:stop]
            size = np.array([len(words[i]) for i in part])
            of = np.repeat(np.arange(len(part)), size)
            pos = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
            token = self.letters[np.frombuffer(b"".join([words[i] for i in part]), np.uint8)]
            last = pos == size[of] - 1
            follower = np.append(token[1:], 0)
            self.db.register("letters", pa.table({
                "word": pa.array(of, pa.int32()), "pos": pa.array(pos, pa.int32()), "token": pa.array(token, pa.int32()),
                "fpos": pa.array(pos + 1, pa.int32(), mask=last), "ftoken": pa.array(follower, pa.int32(), mask=last)}))
            found = self.db.sql(ENCODE).to_arrow_table()
            self.db.unregister("letters")
            tokens = found["tokens"].combine_chunks()
            raw, ends = tokens.flatten().to_numpy().astype(np.int32).tobytes(), (np.cumsum(tokens.value_lengths().to_numpy()) * 4).tolist()
            for i, ids, a, b in zip(found["word"].to_pylist(), found["ids"].to_pylist(), [0, *ends], ends):  # the last start has no end
                out[part[i]] = (ids, raw[a:b])
        return out

    def decode_all(self, sequences: list[list[int]]) -> list[bytes]:
        """Bytes of each list of ids."""
        out = [b""] * len(sequences)
        self.db.register("sequences", pa.table({"id": pa.array(range(len(sequences)), pa.int32()), "ids": pa.array(sequences, pa.list_(pa.int32()))}))
        found = self.db.sql(DECODE).to_arrow_table()
        self.db.unregister("sequences")
        for i, text in zip(found["id"].to_pylist(), found["bytes"].to_pylist(), strict=True):
            out[i] = bytes.fromhex(text)
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of one list of ids, each looked up in its place."""
        size = self.lengths[ids]
        before = np.cumsum(size) - size
        return self.letters_of[np.repeat(self.starts[ids] - before, size) + np.arange(int(size.sum()))].tobytes()

    def learn(self, words: list[str]) -> None:
        self.words.update(zip(words, self.encode_words([w.encode() for w in words]), strict=True))

    def encode(self, texts: list[str | None]) -> Iterator[tuple[str, bytes]]:
        """Ids of each text as decimals joined by spaces, and what these ids are decoded to."""
        at = 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size + len(texts[stop] or "") <= TOGETHER):
                size += len(texts[stop] or "")
                stop += 1
            split = [self.split(t or "") for t in texts[at:stop]]
            distinct = set().union(*split)
            if new := [w for w in distinct if w not in self.words]:
                if len(self.words) + len(new) > REMEMBERED:  # what this text needs is kept
                    self.words = {w: self.words[w] for w in distinct if w in self.words}
                self.learn(new)
            for words in split:
                found = [self.words[w] for w in words]
                yield " ".join([f[0] for f in found]), self.decode(np.frombuffer(b"".join([f[1] for f in found]), np.int32))
            at = stop


_codecs: dict[tuple[str, str], Codec] = {}


def codec(ranks_path: str, pattern: str) -> Codec:
    """The codec of this process; it is built once."""
    key = (ranks_path, pattern)
    if key not in _codecs:
        _codecs[key] = Codec(ranks_path, pattern)
    return _codecs[key]


def encode_texts(docs: DataFrame, keep: list[str], ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """Columns ``keep``, ``ids`` (decimals joined by spaces) and ``decoded`` (bytes) of every row's text."""
    return _mapped(docs, keep, ranks, pattern, "ids string, decoded binary", lambda found: (
        pa.array([f[0] for f in found]), pa.array([f[1] for f in found], pa.binary())))


def digest_texts(docs: DataFrame, keep: list[str], ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """As ``encode_texts``, with the number of ids and hashes in place of ids and bytes."""
    return _mapped(docs, keep, ranks, pattern, "n_tokens long, ids_sha256 string, decoded_sha256 string", lambda found: (
        pa.array([f[0].count(" ") + 1 if f[0] else 0 for f in found], pa.int64()),
        pa.array([hashlib.sha256(f[0].encode()).hexdigest() for f in found], pa.string()),
        pa.array([hashlib.sha256(f[1]).hexdigest() for f in found], pa.string())))


def _mapped(docs: DataFrame, keep: list[str], ranks: str | None, pattern: str | None, more: str, columns) -> DataFrame:
    path, split = ranks or default_ranks(), pattern or default_pattern()
    names = [x.split()[0] for x in more.split(", ")]
    keep = [c for c in keep if c not in names]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col("text").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, split)
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                found = list(coder.encode(part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column(0), *columns(found)], names=["row", *names])

    done = rows.mapInArrow(encode, f"row {rows.schema['row'].dataType.simpleString()}, {more}")
    return done.select(*[F.col("row")[c].alias(c) for c in keep], *names)


def decode_texts(rows: DataFrame, ids: str = "ids", name: str = "decoded", ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """``rows`` with the bytes that the decimals in ``ids`` stand for; a null or empty list stands for nothing."""
    path, split = ranks or default_ranks(), pattern or default_pattern()
    kept = [c for c in rows.columns if c != name]
    slim = rows.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{ids}`").alias("ids"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, split)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                lists = [list(map(int, (x or "").split())) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(coder.decode_all(lists), pa.binary())], names=["row", "decoded"])

    done = slim.mapInArrow(decode, f"row {slim.schema['row'].dataType.simpleString()}, decoded binary")
    return done.select(*[F.col("row")[c].alias(c) for c in kept], F.col("decoded").alias(name))


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_texts(table(spark, sf_dir, "documents"), ["doc_id"])


SQL = None  # tests/llm compares with the published library
