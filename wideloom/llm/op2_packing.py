"""Packing: vector bin packing with the dot-product heuristic.

Examples go into sequences under three limits at once: tokens, segments
(examples in one sequence) and loss-bearing tokens.  The open sequence takes
the fitting example whose demand vector has the largest dot product with the
sequence's remaining capacity (both as shares of the limits), so a sequence
that is short of segments takes long examples, one that is short of
loss-bearing tokens takes those with long prompts.

Packing is local to a Spark partition: a task reads its rows, packs blocks of
``BLOCK`` examples and carries what does not fill a sequence on to the next
block.  There is no shuffle, memory is one block, and a lost task is simply
packed again from the same rows.  The padding is at most one open sequence per
task; with ``cut=True`` there is none (below).

With ``cut=True`` (plain text: every token bears loss, examples may be cut) an
example longer than a sequence first gives full sequences.  When nothing fits
any more, the best example by the same product is cut to fill the sequence, and
its rest is packed later.  The last tokens of a task go to sequences of power-of-two lengths,
which need no padding.

Edge cases: a null or empty text is its end id alone; repeated rows are packed
each; an example that exceeds a limit on its own gets a sequence of its own
when it cannot be cut (``oversized`` is then true); empty input, no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .bpe import ByteBpe
from .common import map_batches, read_table

BLOCK = 4096  # examples that a task holds at once


@dataclass(frozen=True)
class Limits:
    """Capacity of one sequence."""
    tokens: int = 1024
    segments: int = 256
    loss: int = 1024

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.segments, self.loss], dtype=np.float64)


@dataclass
class Sequence:
    capacity: np.ndarray                            # remaining tokens, segments, loss
    members: list[tuple[int, int, int]] = field(default_factory=list)  # (item, start in item, tokens)


class Block:
    """Examples that wait to be placed: demands (tokens, 1, loss), a column per limit."""

    def __init__(self, tokens: np.ndarray, loss: np.ndarray, limits: Limits, cut: bool):
        self.demand = [v.astype(np.float64) for v in (tokens, np.ones_like(tokens), loss)]
        self.cap, self.cut = limits.vector(), cut
        self.share = [d / c for d, c in zip(self.demand, self.cap)]
        self.start = np.zeros(len(tokens), dtype=np.int64)
        self.alive = np.ones(len(tokens), dtype=bool)
        self.left = float(self.demand[0].sum())

    def best(self, room: np.ndarray, fitting: bool = True) -> int:
        """Index of the largest dot product with ``room``, or -1; ties go to
        the first example."""
        if not len(self.alive):
            return -1
        x, y, z = (room / self.cap).tolist()
        score = self.share[0] * x
        score += self.share[1] * y
        score += self.share[2] * z
        ok = self.alive
        if fitting:
            for d, r in zip(self.demand, room.tolist()):
                ok = ok & (d <= r)
        score[~ok] = -1.0
        k = int(score.argmax())
        return k if score[k] >= 0 else -1

    def place(self, seq: Sequence, k: int, tokens: int) -> None:
        seq.members.append((k, int(self.start[k]), tokens))
        part = np.array([d[k] for d in self.demand])
        if tokens < part[0]:
            part = np.array([tokens, 1, tokens], dtype=np.float64)
            for i in (0, 2):
                self.demand[i][k] -= tokens
                self.share[i][k] = self.demand[i][k] / self.cap[i]
            self.start[k] += tokens
        else:
            self.alive[k] = False
        seq.capacity = seq.capacity - part
        self.left -= tokens

    def fill(self, capacity: np.ndarray) -> Sequence:
        """Pack one sequence.  An example beyond the limits that cannot be cut
        becomes a sequence alone."""
        seq = Sequence(capacity.copy())
        while (k := self.best(seq.capacity)) >= 0:
            self.place(seq, k, int(self.demand[0][k]))
        room = int(min(seq.capacity[0], seq.capacity[2]))
        if self.cut and room > 0 and seq.capacity[1] >= 1 and (k := self.best(seq.capacity, fitting=False)) >= 0:
            self.place(seq, k, min(room, int(self.demand[0][k])))
        elif not seq.members and (k := self.best(seq.capacity, fitting=False)) >= 0:
            self.place(seq, k, int(self.demand[0][k]))
        return seq


def pack_block(tokens: np.ndarray, loss: np.ndarray, limits: Limits, cut: bool, last: bool
               ) -> tuple[list[Sequence], Block]:
    """Pack a block; while ``last`` is false, what is left when less than two
    sequences' worth of tokens remain stays in the returned block."""
    block = Block(tokens, loss, limits, cut)
    cap, done = limits.vector(), []
    while block.alive.any():
        if cut and block.left < cap[0]:
            if not last:
                break
            whole = 1 << (int(block.left).bit_length() - 1)  # largest power of two
            done.append(block.fill(np.array([whole, cap[1], min(whole, cap[2])], dtype=np.float64)))
        elif not last and block.left < 2 * cap[0] and (cut or block.alive.sum() <= min(2 * cap[1], BLOCK // 2)):
            break  # whole examples go on as long as they are too many to wait, also if they hold no tokens
        else:
            done.append(block.fill(cap))
    return done, block


def pack_examples(df: DataFrame, id_col: str, tokens: str = "n_tokens", loss: str = "n_loss",
                  limits: Limits = Limits()) -> DataFrame:
    """Place whole examples.  Rows: ``id_col``, ``sequence_id`` (unique over
    the table), ``segment`` (its place there, from 0), ``offset``,
    ``n_tokens``, ``n_loss``, ``oversized``.  A null or negative count is 0; more loss-bearing tokens than
    tokens count as all tokens."""
    kind = df.schema[id_col].dataType.simpleString()
    schema = (f"`{id_col}` {kind}, sequence_id long, segment int, offset long, n_tokens long, n_loss long, "
              "oversized boolean")

    def run(batches: Iterator[tuple[list, ...]]) -> Iterator[tuple]:
        base, count, ids, tok, los = TaskContext.get().partitionId() << 33, 0, [], [], []

        def flush(last: bool) -> tuple:
            nonlocal count, ids, tok, los
            t, l = np.array(tok, dtype=np.int64), np.array(los, dtype=np.int64)
            done, block = pack_block(t, l, limits, cut=False, last=last)
            out = []
            for seq in done:
                offset = 0
                for s, (k, _, n) in enumerate(seq.members):
                    out.append((ids[k], base + count, s, offset, int(t[k]), int(l[k]),
                                bool(t[k] > limits.tokens or l[k] > limits.loss)))
                    offset += n
                count += 1
            rest = np.nonzero(block.alive)[0]
            ids, tok, los = ([v[k] for k in rest] for v in (ids, tok, los))
            return tuple(zip(*out)) if out else ([],) * 7

        for i, t, l in batches:
            t = [max(x or 0, 0) for x in t]
            ids, tok, los = ids + i, tok + t, los + [min(max(x or 0, 0), n) for x, n in zip(l, t)]
            while len(ids) >= BLOCK:
                more = (ids[BLOCK:], tok[BLOCK:], los[BLOCK:])
                ids, tok, los = ids[:BLOCK], tok[:BLOCK], los[:BLOCK]
                yield flush(last=False)
                ids, tok, los = ids + more[0], tok + more[1], los + more[2]
        yield flush(last=True)

    return map_batches(df.select(id_col, tokens, loss), schema, run)


PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "segment int")


def pack_texts(df: DataFrame, id_col: str, text: str, tokenizer: str, end_id: int = 0,
               limits: Limits = Limits()) -> DataFrame:
    """Tokenise, cut and place every text; a row per piece (``PIECES``)."""

    def run(batches: Iterator[tuple[list, ...]]) -> Iterator[tuple]:
        bpe = ByteBpe.open(tokenizer)
        end = np.array([end_id], dtype="<u4").tobytes()
        base, count = TaskContext.get().partitionId() << 33, 0
        size = min(limits.tokens, limits.loss)
        wait: list[tuple] = []  # (doc_id, start, id bytes, doc tokens)

        def pack(last: bool) -> list[tuple]:
            nonlocal count, wait
            t = np.array([len(w[2]) // 4 for w in wait], dtype=np.int64)
            done, block = pack_block(t, t, limits, cut=True, last=last)
            rows = []
            for seq in done:
                offset = 0
                for s, (k, start, n) in enumerate(seq.members):
                    doc, first, raw, total = wait[k]
                    piece = raw[4 * start:4 * (start + n)]
                    rows.append((doc, first + start, n, zlib.crc32(piece), total, base + count, offset, s))
                    offset += n
                count += 1
            wait = [(w[0], w[1] + int(block.start[k]), w[2][4 * int(block.start[k]):], w[3])
                    for k, w in enumerate(wait) if block.alive[k]]
            return rows

        for docs, texts in batches:
            rows: list[tuple] = []
            for doc, raw in zip(docs, bpe.encode_many(texts)):
                raw += end
                total, start = len(raw) // 4, 0
                while total - start >= size:  # full sequences, placed at once
                    rows.append((doc, start, size, zlib.crc32(raw[4 * start:4 * (start + size)]), total,
                                 base + count, 0, 0))
                    count, start = count + 1, start + size
                if start < total:
                    wait.append((doc, start, raw[4 * start:], total))
                if len(wait) >= BLOCK:
                    rows += pack(last=False)
            if rows:
                yield tuple(zip(*rows))
        if rows := pack(last=True):
            yield tuple(zip(*rows))
        bpe.cache.clear()  # the worker outlives the task

    return map_batches(df.select(id_col, text), PIECES.replace("doc_id long", f"`{id_col}` long", 1), run)


def _tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return pack_texts(docs, "doc_id", "text", _tokenizer())


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage (the last): the pieces of all documents."""
    return pack_texts(docs, "doc_id", "text", _tokenizer())
