"""Vector bin packing of token pieces into sequences.

`tokenize` turns each document into pieces of at most `max_tokens` ids, with the end id last.
`pack` places pieces in sequences under simultaneous limits on tokens, segments and loss-bearing
tokens by the dot-product heuristic: a sequence is filled with the fitting piece whose demand has the
largest dot product with what the sequence has left, each dimension weighted by how scarce it is.

A piece that fills a sequence alone needs no partner. The others are dealt into groups of about
`GROUP` pieces by a counter, not by a key, so no document, source or repeated row can make a group
large; a group is packed in one task. Only numbers are shuffled, never texts or ids. At most the
last sequences of each group stay partly filled.

Defined results: a null or empty text is the end id alone; repeated rows are packed each; a piece
over a limit of its own (more loss-bearing tokens than a sequence may have) gets its own sequence;
no pieces, no sequences; a very long text is cut into as many pieces as it takes.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardflow.llm import kept
from cardflow.llm.tables import saved
from cardflow.llm.units import LONGEST, Cache, groups

GROUP = 8192
FULL = 1 << 62
#: Units in one call of the tokenizer: longer texts take more time a unit.
LINES = 64

PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, loss_tokens long, "
    "slot long"
)


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 256
    loss: int = 2048


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _cache(path: str) -> Cache:
    mine = kept.of(kept.TOKENS)
    if path not in mine:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)

        line_feed = tokenizer.encode("\n", add_special_tokens=False).ids[0]

        def encode(units: list[str]) -> list[bytes]:
            """Units without white space at an end go as lines of one text, which spares most of
            the work around each: a line feed between two of them is a token of its own."""
            out: list[bytes] = [b""] * len(units)
            alone = [len(u) > LONGEST or "\n" in u or u.isspace() for u in units]
            lines = [i for i, a in enumerate(alone) if not a]
            for at in range(0, len(lines), LINES):
                part = lines[at : at + LINES]
                text = "\n".join([units[i] for i in part])
                (e,) = tokenizer.encode_batch_fast([text], add_special_tokens=False)
                ids = np.array(e.ids, dtype="<u4")
                cuts = (np.flatnonzero(ids == line_feed) * 4).tolist()
                data = ids.tobytes()
                for i, start, stop in zip(part, [0, *[c + 4 for c in cuts]], [*cuts, len(data)], strict=True):
                    out[i] = data[start:stop]
            rest = [i for i, a in enumerate(alone) if a]
            for i, e in zip(rest, tokenizer.encode_batch_fast([units[i] for i in rest], add_special_tokens=False)):
                out[i] = np.array(e.ids, dtype="<u4").tobytes()
            return out

        mine[path] = Cache(encode)
    return mine[path]


def tokenize(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", max_tokens: int = 2048, end_id: int = 1) -> DataFrame:
    """Pieces of every document: id, start, length, crc of the ids, tokens of the document, tokens
    that bear loss (all but the end id) and a slot number."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _cache(path)
        task = TaskContext.get().partitionId() << 36
        made = 0
        for batch in batches:
            ids = batch.column(0)
            at = 0
            for texts in groups(batch.column(1).to_pylist()):
                rows = []
                for k, parts in enumerate(cache.texts(texts)):
                    data = b"".join(parts) + end
                    n = len(data) // 4
                    for start in range(0, n, max_tokens):
                        stop = min(n, start + max_tokens)
                        rows.append(
                            (at + k, start, stop - start, zlib.crc32(data[4 * start : 4 * stop]), n, stop - start - (stop == n))
                        )
                at += len(texts)
                columns = np.array(rows, dtype=np.int64).T
                slots = task + made + np.arange(len(rows))
                made += len(rows)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(columns[0])), *map(pa.array, columns[1:]), pa.array(slots)],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "loss_tokens", "slot"],
                )

    return docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, PIECE)


def fill(tokens: np.ndarray, loss: np.ndarray, limits: Limits) -> np.ndarray:
    """The sequence of each piece. Pieces of equal demand are one class, so a step looks at classes."""
    demand, member = np.unique(np.stack([tokens, loss], axis=1), axis=0, return_inverse=True)
    member = member.ravel()
    order = np.argsort(member, kind="stable")
    queue = np.concatenate([[0], np.cumsum(np.bincount(member, minlength=len(demand)))])
    left, next_ = np.diff(queue), queue[:-1].copy()
    t, l = demand[:, 0].astype(np.float64), demand[:, 1].astype(np.float64)
    n = len(tokens)
    caps = np.array([limits.tokens, limits.segments, limits.loss], dtype=np.float64)
    weight = np.array([tokens.sum(), n, loss.sum()]) / caps
    weight /= max(weight.sum(), 1e-9)
    classes = np.arange(len(demand))
    out = np.empty(n, dtype=np.int64)
    sequence = done = 0
    while done < n:
        free = caps.copy()
        empty = True
        while True:
            ok = (left > 0) & (t <= free[0]) & (l <= free[2]) if free[1] >= 1 else left < 0
            if not ok.any():
                if not empty:
                    break
                ok = left > 0  # over a limit by itself
            gain = weight * free / caps**2
            score = np.where(ok, gain[0] * t + gain[1] + gain[2] * l, -1.0)
            k = int(score.argmax())
            out[order[next_[k]]] = sequence
            next_[k] += 1
            left[k] -= 1
            done += 1
            free -= (t[k], 1, l[k])
            empty = False
            if not left[k] and len(left) > 64 and (left > 0).mean() < 0.5:
                live = left > 0
                t, l, left, next_, classes = t[live], l[live], left[live], next_[live], classes[live]
            if done == n:
                break
        sequence += 1
    return out


def pack(pieces: DataFrame, n_pieces: int, limits: Limits = Limits(), group: int = GROUP) -> DataFrame:
    """`pieces` (with length, loss_tokens and a `slot` number) with sequence_id and the gapless
    offset in it. `n_pieces`: about how many pieces there are, for the number of groups."""
    n_groups = max(1, -(-n_pieces // group))
    columns = [c for c in pieces.columns if c != "slot"]
    full = pieces.where(F.col("length") >= limits.tokens).select(
        *columns,
        F.col("slot").bitwiseOR(F.lit(FULL)).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    rest = pieces.where(F.col("length") < limits.tokens).withColumn(
        "_group", F.pmod(F.xxhash64("slot"), F.lit(n_groups))
    )

    def place(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("slot", kind="stable")
        rows["sequence_id"] = (int(key[0]) << 32) + fill(
            rows["length"].to_numpy(), rows["loss_tokens"].to_numpy(), limits
        )
        by = rows.groupby("sequence_id", sort=False)["length"]
        rows["offset"] = by.cumsum() - rows["length"]
        return rows[[*columns, "sequence_id", "offset"]].astype({"sequence_id": "int64", "offset": "int64"})

    return full.unionByName(rest.groupBy("_group").applyInPandas(place, full.schema))


def pack_documents(docs: DataFrame, path: str | None = None, limits: Limits = Limits()) -> DataFrame:
    """Every document's pieces with their places. The pieces are kept in the shared folder, so that
    texts are tokenized once for both kinds of pieces."""
    pieces = saved(tokenize(docs, path or tokenizer_path(), max_tokens=limits.tokens), "pieces")
    n_open = pieces.where(F.col("length") < limits.tokens).count()
    return pack(pieces, n_open, limits)
