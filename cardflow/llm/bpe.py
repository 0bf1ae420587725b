"""Byte-level BPE by recursive queries of an in-task DuckDB.

Texts are cut into units (see `units`), units into the matches of the tokenizers' pattern. New
matches of a batch become token-position rows, one per byte. A recursive query joins neighbouring
tokens with the merge table, contracts the leftmost pair of least rank of each word and repeats until
no word has a pair left. A match longer than `LONG` bytes would take one step per byte; it is
contracted by the same rule with a heap instead. Decoding joins ids with the vocabulary and
concatenates the bytes in order of position.

Spark partitions the documents; a task holds one batch of texts, a bounded cache of units and a
DuckDB limited to `MEMORY`, which never touches the disk.

Defined results: a null or empty text has no ids; repeated rows have equal results; a very long text
is encoded unit by unit and decoded in slices, within the same memory of DuckDB.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardflow.llm import kept
from cardflow.llm.units import Cache, groups

#: Below 1000, the factor in CONTRACT.
LONG = 96
MEMORY = "300MB"
WORDS = 10_000
#: Ids that one decoding query takes.
DECODED = 1 << 18

CONTRACT = """
WITH RECURSIVE state(word, step, pos, tok) AS (
    SELECT word, 0, pos, tok FROM bytes
  UNION ALL
    SELECT s.word, s.step + 1, s.pos - (s.pos > f.at)::INT,
           CASE WHEN s.pos = f.at THEN f.made ELSE s.tok END
    FROM state s JOIN (
        SELECT l.word, min(m.rank::BIGINT * 1000 + l.pos) AS least,
               (least // 1000)::INT AS made, (least % 1000)::INT AS at
        FROM state l
        JOIN state r ON r.word = l.word AND r.pos = l.pos + 1
        JOIN merges m ON m.a = l.tok AND m.b = r.tok
        GROUP BY l.word
    ) f ON f.word = s.word AND s.pos <> f.at + 1
)
SELECT word, list(tok ORDER BY pos) AS ids
FROM state JOIN (SELECT word, max(step) AS final FROM state GROUP BY word) USING (word)
WHERE step = final GROUP BY word ORDER BY word
"""

DECODE = """
SELECT doc, string_agg(v.hex, '' ORDER BY i.pos) AS hex
FROM ids i JOIN vocabulary v ON v.id = i.id GROUP BY doc ORDER BY doc
"""


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Codec:
    """Encodes and decodes with the ranks of one file."""

    def __init__(self, path: str):
        import duckdb
        import public_tokenizers
        import regex

        self.pattern = regex.compile(public_tokenizers.PATTERN)
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        merges = [
            (ranks_a, ranks_b, rank)
            for token, rank in self.ranks.items()
            for i in range(1, len(token))
            if (ranks_a := self.ranks.get(token[:i])) is not None
            and (ranks_b := self.ranks.get(token[i:])) is not None
        ]
        a, b, rank = (np.array(x, dtype=np.int32) for x in zip(*merges))
        self.db = duckdb.connect(
            ":memory:", config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""}
        )
        merge_rows = pa.table({"a": a, "b": b, "rank": rank})  # noqa: F841
        vocabulary_rows = pa.table(  # noqa: F841
            {
                "id": pa.array(list(self.ranks.values()), pa.int32()),
                "hex": [token.hex() for token in self.ranks],
            }
        )
        self.db.execute("CREATE TABLE merges AS SELECT a, b, rank FROM merge_rows")
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM vocabulary_rows")
        self.units = Cache(self._units)

    def _units(self, units: list[str]) -> Iterator[bytes]:
        cut = [self.pattern.findall(u) for u in units]
        matches = list({m for ms in cut for m in ms})
        ids = dict(zip(matches, self._matches(matches)))
        for ms in cut:
            yield b"".join([ids[m] for m in ms])

    def _matches(self, matches: list[str]) -> list[bytes]:
        words = [m.encode() for m in matches]
        out: list[bytes] = [b""] * len(words)
        open_ = []
        for i, w in enumerate(words):
            if len(w) > LONG:
                out[i] = np.array(self.contract_long(w), dtype="<u4").tobytes()
            elif w in self.ranks:
                out[i] = np.array([self.ranks[w]], dtype="<u4").tobytes()
            else:
                open_.append(i)
        for i in range(0, len(open_), WORDS):
            part = open_[i : i + WORDS]
            lengths = np.array([len(words[k]) for k in part])
            data = np.frombuffer(b"".join([words[k] for k in part]), dtype=np.uint8)
            word = np.repeat(np.arange(len(part), dtype=np.int32), lengths)
            pos = np.arange(len(data)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            bytes = pa.table({"word": word, "pos": pos.astype(np.int32), "tok": self.byte[data]})  # noqa: A001, F841
            ids = self.db.sql(CONTRACT).to_arrow_table().column("ids").combine_chunks()
            flat = ids.flatten().to_numpy().astype("<u4").tobytes()
            at = ids.offsets.to_numpy() * 4
            for k, a, b in zip(part, at[:-1].tolist(), at[1:].tolist()):
                out[k] = flat[a:b]
        return out

    def contract_long(self, word: bytes) -> list[int]:
        """The same rule for one long match: the pair of least rank, the leftmost first."""
        n = len(word)
        token = [word[i : i + 1] for i in range(n)]
        next_, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, bytes, bytes]] = []

        def offer(i: int) -> None:
            j = next_[i]
            if j < n and (rank := self.ranks.get(token[i] + token[j])) is not None:
                heapq.heappush(heap, (rank, i, token[i], token[j]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = next_[i]
            if token[i] != left or j >= n or token[j] != right:
                continue  # one of the two is part of a longer token by now
            token[i], token[j] = left + right, b""
            next_[i] = next_[j]
            if next_[j] < n:
                before[next_[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        out, i = [], 0
        while i < n:
            out.append(self.ranks[token[i]])
            i = next_[i]
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(b"".join(parts), dtype="<u4") for parts in self.units.texts(texts)]

    def decode(self, rows: list[np.ndarray]) -> list[bytes]:
        """The bytes of each row of ids. Long rows go in slices, each an ordered aggregation, so memory
        does not depend on their length."""
        out: list[list[bytes]] = [[] for _ in rows]
        part: list[tuple[int, np.ndarray]] = []
        size = 0
        for k, row in enumerate(rows):
            for at in range(0, len(row), DECODED):
                part.append((k, row[at : at + DECODED]))
                size += len(part[-1][1])
                if size >= DECODED:
                    self._decode(part, out)
                    part, size = [], 0
        if part:
            self._decode(part, out)
        return [b"".join(p) for p in out]

    def _decode(self, part: list[tuple[int, np.ndarray]], out: list[list[bytes]]) -> None:
        lengths = np.array([len(ids) for _, ids in part])
        ids = pa.table(  # noqa: F841
            {
                "doc": np.repeat(np.arange(len(part), dtype=np.int32), lengths),
                "pos": np.arange(lengths.sum(), dtype=np.int32),
                "id": np.concatenate([ids for _, ids in part]).astype(np.int32),
            }
        )
        for doc, text in sorted(self.db.execute(DECODE).fetchall()):
            out[part[doc][0]].append(bytes.fromhex(text))


def ids_digest(ids: np.ndarray) -> str:
    """Of the decimal ids joined by one space."""
    h = hashlib.sha256()
    for at in range(0, len(ids), 1 << 16):
        part = " ".join(map(str, ids[at : at + (1 << 16)].tolist()))
        h.update((" " + part if at else part).encode())
    return h.hexdigest()


def codec(path: str) -> Codec:
    mine = kept.of(kept.TOKENS)
    if path not in mine:
        mine[path] = Codec(path)
    return mine[path]


def encode_decode(docs: DataFrame, path: str | None = None, id: str = "doc_id", text: str = "text", real: bool = True) -> DataFrame:
    """id, n_tokens, ids_sha256 and decoded_sha256 of each text; with `real`, also ids and decoded."""
    path = path or vocabulary_path()
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if real:
        schema += ", ids array<int>, decoded binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            at = 0
            for texts in groups(batch.column(1).to_pylist()):
                rows = c.encode(texts)
                decoded = c.decode(rows)
                out = {
                    "doc_id": batch.column(0).slice(at, len(texts)),
                    "n_tokens": pa.array([len(r) for r in rows], pa.int64()),
                    "ids_sha256": [ids_digest(r) for r in rows],
                    "decoded_sha256": [hashlib.sha256(d).hexdigest() for d in decoded],
                }
                if real:
                    out["ids"] = pa.array([r.tolist() for r in rows], pa.list_(pa.int32()))
                    out["decoded"] = pa.array(decoded, pa.binary())
                at += len(texts)
                yield pa.RecordBatch.from_pydict(out)

    return docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)
