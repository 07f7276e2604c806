"""Byte-level BPE encoding and decoding with DuckDB recursive queries in each partition.

A text is cut into pieces by the vocabulary's pattern. Every distinct new piece of a block of texts
becomes token-position rows, keyed by word and place; the recursive query joins adjacent tokens with the merge table and
contracts each word's leftmost pair of minimum rank until no word has a pair left. Where the new tokens form no pair of
lower rank with what stands next to them, the pair's other places in the word come next in any case and are
contracted in the same step, so a word takes as many steps as it has different pairs to contract. A block's ids are decoded by joining the vocabulary and
aggregating in position order. A bounded cache keeps the ids of pieces between blocks, so merging follows distinct pieces
rather than running text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlake.llm.common import small_batches

#: Bytes of a word that is contracted pair by pair, with its word and place in one number.
SLOTS = 64
#: Rows that one run of the recursive query may make; longer work goes on from the state it has reached.
STATE_ROWS = 2_000_000

SHORT_SQL = f"""
WITH RECURSIVE state(step, place, token) AS (
  SELECT 0, place, token FROM start
  UNION ALL
  (WITH pairs AS (
     SELECT step, place, token, lead(token) OVER w AS next_token, lead(place) OVER w AS next_place
     FROM state WINDOW w AS (ORDER BY place)),
   best AS (
     SELECT place // {SLOTS} AS word, min(merged::BIGINT * {SLOTS} + place % {SLOTS}) AS pick,
       arg_min(next_place, merged::BIGINT * {SLOTS} + place % {SLOTS}) AS absorbed
     FROM pairs JOIN merges ON first = token AND second = next_token
     WHERE place // {SLOTS} = next_place // {SLOTS} GROUP BY 1)
   SELECT step + 1, place, CASE WHEN place % {SLOTS} = pick % {SLOTS} THEN (pick // {SLOTS})::INTEGER ELSE token END
   FROM pairs JOIN best ON word = place // {SLOTS}
   WHERE place <> absorbed)
)
SELECT word, list(token ORDER BY place) AS ids
FROM state JOIN (SELECT place // {SLOTS} AS word, max(step) AS final FROM state GROUP BY 1) ON word = place // {SLOTS}
WHERE step = final GROUP BY word ORDER BY word
"""

#: The same for words of any length, with places that can be contracted in one step.
MERGE_SQL = """
WITH RECURSIVE state(step, word, place, token) AS (
  SELECT 0, word, place, token FROM start
  UNION ALL
  (WITH pairs AS (
     SELECT step, word, place, token, row_number() OVER w AS i,
       lead(token) OVER w AS next_token, lag(token) OVER w AS left_token, lead(token, 2) OVER w AS right_token
     FROM state WINDOW w AS (PARTITION BY word ORDER BY place)),
   ranked AS (
     SELECT pairs.*, merged, early, min(merged) OVER (PARTITION BY word) AS least
     FROM pairs LEFT JOIN merges ON first = token AND second = next_token),
   picks AS (
     SELECT word, i, early, least, left_token, right_token, row_number() OVER (PARTITION BY word ORDER BY i) AS n
     FROM ranked WHERE merged = least),
   near AS (
     SELECT word, least, left_token AS first, least AS second FROM picks WHERE early UNION ALL
     SELECT word, least, least, right_token FROM picks WHERE early UNION ALL SELECT word, least, least, least FROM picks WHERE early),
   alone AS (SELECT DISTINCT word FROM near JOIN merges USING (first, second) WHERE merged < least),
   chosen AS (
     SELECT word, i FROM (SELECT *, (i - min(i) OVER (PARTITION BY word, i - n)) % 2 AS odd FROM picks)
     WHERE n = 1 OR odd = 0 AND word NOT IN (SELECT word FROM alone))
   SELECT step + 1, r.word, place, CASE WHEN c.i IS NOT NULL THEN least ELSE token END
   FROM ranked r LEFT JOIN chosen c ON c.word = r.word AND c.i = r.i LEFT JOIN chosen d ON d.word = r.word AND d.i = r.i - 1
   WHERE least IS NOT NULL AND d.i IS NULL AND step < {steps})
),
last AS (SELECT word, max(step) AS step FROM state GROUP BY word)
SELECT word, list(token ORDER BY place) AS ids, any_value(step) >= {steps} AS open FROM state JOIN last USING (word, step) GROUP BY word ORDER BY word
"""

DECODE_SQL = """
SELECT text, array_to_string(list(piece ORDER BY spot), '') AS bytes
FROM given JOIN vocabulary USING (id) GROUP BY text ORDER BY text
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class ByteBPE:
    """Encoder and decoder of one rank file; ids equal those of the ``tiktoken`` library."""

    def __init__(self, path: str, pattern: str, cache_pieces: int = 300_000):
        import duckdb
        import regex

        self.ranks = read_ranks(path)
        self.pattern = regex.compile(pattern)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        found = ((self.ranks.get(t[:k]), self.ranks.get(t[k:]), r) for t, r in self.ranks.items() for k in range(1, len(t)))
        rows = np.array([x for x in found if x[0] is not None and x[1] is not None], np.int32).reshape(-1, 3)
        later = rows[rows[:, 2] < rows[:, :2].max(1)]  # tokens that come before a part of theirs
        early = np.isin(rows[:, 2], later[:, :2])
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "500MB"})
        self.db.execute("SET temp_directory = ''")
        self.db.register("given", pa.table({"first": rows[:, 0], "second": rows[:, 1], "merged": rows[:, 2], "early": early}))
        self.db.execute("CREATE TABLE merges AS SELECT * FROM given")
        self.db.unregister("given")
        # bytes as the characters of the same code: DuckDB's strings must be valid UTF-8
        tokens = {"id": np.fromiter(self.ranks.values(), np.int32), "piece": [t.decode("latin-1") for t in self.ranks]}
        self.db.register("given", pa.table(tokens))
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM given")
        self.db.unregister("given")
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.cache_pieces = cache_pieces

    def _query(self, name: str, rows: pa.Table, sql: str) -> pa.Table:
        self.db.register(name, rows)
        try:
            return self.db.sql(sql).to_arrow_table()
        finally:
            self.db.unregister(name)

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """The bytes of each id sequence."""
        sizes = [len(x) for x in ids]
        flat = np.concatenate([*ids, np.zeros(0, np.int32)]).astype(np.int32)
        rows = pa.table({"text": np.repeat(np.arange(len(ids)), sizes), "spot": np.arange(len(flat)), "id": flat})
        got = self._query("given", rows, DECODE_SQL)
        out = [b""] * len(ids)
        for i, piece in zip(got["text"].to_pylist(), got["bytes"].to_pylist(), strict=True):
            out[i] = piece.encode("latin-1")
        return out

    def _merge_short(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The ids of pieces of at most ``SLOTS`` bytes."""
        lengths = np.array([len(p) for p in pieces], np.int64)
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        word = np.repeat(np.arange(len(pieces), dtype=np.int64), lengths)
        at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        ids = self._query("start", pa.table({"place": word * SLOTS + at, "token": self.byte_ids[flat]}), SHORT_SQL)["ids"].combine_chunks()
        values, offsets = ids.values.to_numpy(), ids.offsets.to_numpy()
        return [values[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]

    def _merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The ids of each piece, of any length; a run of the query whose steps are used up is followed by another from where it stopped."""
        tokens = [self.byte_ids[np.frombuffer(p, np.uint8)] for p in pieces]
        left = np.arange(len(pieces))
        while len(left):
            lengths = [len(tokens[i]) for i in left]
            places = np.concatenate([np.arange(n, dtype=np.int32) for n in lengths])
            start = pa.table({"word": np.repeat(left, lengths), "place": places, "token": np.concatenate([tokens[i] for i in left])})
            got = self._query("start", start, MERGE_SQL.format(steps=max(8, STATE_ROWS // start.num_rows)))
            ids = got["ids"].combine_chunks()
            values, offsets = ids.values.to_numpy(), ids.offsets.to_numpy()
            for word, a, b in zip(got["word"].to_pylist(), offsets, offsets[1:], strict=False):
                tokens[word] = values[a:b]
            left = got["word"].to_numpy()[got["open"].to_numpy()]
        return tokens

    def _learn(self, pieces: list[str]) -> None:
        """Put the ids of the pieces into the cache, blocks of like length together."""
        data = sorted(((p.encode(), p) for p in pieces), key=lambda x: len(x[0]))
        cut = sum(len(d) <= SLOTS for d, _ in data)
        for at in range(0, cut, 20_000):
            block = data[at : min(at + 20_000, cut)]
            for (_, piece), ids in zip(block, self._merge_short([d for d, _ in block]), strict=True):
                self.cache[piece] = ids.astype("<u4").tobytes()
        at = cut
        while at < len(data):
            end, held = at, 0
            while end < len(data) and (end == at or held < 200_000):
                held += len(data[end][0])
                end += 1
            for (_, piece), ids in zip(data[at:end], self._merge([d for d, _ in data[at:end]]), strict=True):
                self.cache[piece] = ids.astype("<u4").tobytes()
            at = end

    def round_trip(self, texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        """For each text its ids, little-endian unsigned 32-bit, and the bytes that they decode to."""
        out, block, held = [], [], 0
        for text in texts:
            block.append(self.pattern.findall(text or ""))
            held += len(text or "")
            if held >= 2_000_000:
                out += self._block(block)
                block, held = [], 0
        return out + self._block(block)

    def _block(self, texts: list[list[str]]) -> list[tuple[bytes, bytes]]:
        needed = set().union(*texts)
        if len(self.cache) > self.cache_pieces:  # what the next blocks use moves back from the older half
            self.older, self.cache = self.cache, {}
        new = []
        for piece in needed.difference(self.cache):
            if (known := self.older.get(piece)) is None:
                new.append(piece)
            else:
                self.cache[piece] = known
        self._learn(new)
        ids = [b"".join(map(self.cache.__getitem__, pieces)) for pieces in texts]
        return list(zip(ids, self.decode([np.frombuffer(x, "<u4") for x in ids]), strict=True))


_LOADED: dict[tuple[str, str], ByteBPE] = {}


def byte_bpe(path: str, pattern: str) -> ByteBPE:
    """One coder for each worker process, rank file and pattern."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = ByteBPE(path, pattern)
    return _LOADED[path, pattern]


def defaults(path: str | None, pattern: str | None) -> tuple[str, str]:
    import public_tokenizers

    return path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``doc_id, ids, decoded``: each whole text's ids and the bytes decoded from them, both binary.

    A null text counts as empty and has no ids; repeated rows stay repeated; columns other than
    ``doc_id`` and ``text`` are not read; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    path, pattern = defaults(path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_bpe(path, pattern)
        for batch in batches:
            got = coder.round_trip(batch.column(1).to_pylist())
            columns = [batch.column(0), pa.array([x[0] for x in got], pa.binary()), pa.array([x[1] for x in got], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids binary, decoded binary")


def decode(encoded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``doc_id, decoded`` from ``doc_id, ids``; null ids decode to no bytes."""
    path, pattern = defaults(path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_bpe(path, pattern)
        for batch in batches:
            decoded = coder.decode([np.frombuffer(x or b"", "<u4") for x in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(decoded, pa.binary())], ["doc_id", "decoded"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, decoded binary")


def digests(encoded: DataFrame) -> DataFrame:
    """The counts and hashes of :func:`encode`'s rows."""
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
