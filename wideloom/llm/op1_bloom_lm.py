"""Language-model scoring with a log-frequency Bloom filter.

Training counts word n-grams (orders 1 and 2) exactly.  The texts are read once:
every task turns its texts into blocks (``BLOCK_TEXT`` characters), a block's
tokens being numbers into its distinct tokens.  Each block deals its distinct
n-grams with their counts to reducers by n-gram hash, so a token that every
document holds is one row per block, and reducer p builds slice p of the
filter.  An n-gram of count c enters the filter once for
each level up to the highest threshold of ``thresholds()`` that c reaches; the
thresholds are whole numbers that grow by ``UNI_RATIO`` or ``PAIR_RATIO``.  A count is
read back by repeated membership probes, level after level until one misses.

The model interpolates the orders (v: the token before w; the end of a text
stands before its first word)

    P(w)     = (c(w) + 1) / (N + V + 1)
    P(w | v) = share(v) * c(v w) / c(v) + (1 - share(v)) * P(w)

where c(w) and c(v w) are read as their level's lower bound and c(v) as its upper
bound, so the probabilities add up to at most 1 but for false positives
(2**-HASHES a probe).  ``share(v)`` is ``SHARE``, and 0 after tokens that training has
never seen.  Every word pair enters the filter, from count 1 on.

The filter is broadcast.  Its size follows the training data, so it is sent in
shards of at most ``MAX_BROADCAST`` bytes, one after the other.  With more than one,
the blocks' distinct n-grams are written once, by shard; the pass of a shard reads
its own n-grams only, so all passes together cost one look-up per n-gram of a block.
The levels then meet their block, where every token takes its own.

The base score needs exact counts of every token: reducers send each block the
counts of its tokens back, a row per block and slice.

Edge cases: a null or empty text is its end token alone; a null id is a training
row (it has no crc32); repeated rows count and are scored each; a very long text is
a block alone; other columns are not read; empty input
gives no rows; without any training row N = V = 0 and every c is 0.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path
from .common import chain64, map_batches, materialize, mix64, read_table
from .shingles import word_hashes

HASHES = 12                  # hash functions per entry: false positives 2**-12 at half load
SCOUTS = 2                   # of them, asked on the way up; the level found is asked all
PAIR_BITS = 48               # of a pair's key
UNI_RATIO = 1.05             # growth of the count levels of tokens
PAIR_RATIO = 1.05            # and of word pairs
SHARE = 0.15                 # weight of the pair order
MAX_BROADCAST = 64 << 20     # bytes of filter in one broadcast
BLOCK_TEXT = 8 << 20         # characters of a block
REDUCER_TEXT = 16 << 20      # bytes of text per reducer

END = np.uint64(xxhash.xxh3_64_intdigest(b"\n"))  # no word holds a line feed
_UNIGRAM = np.uint64(0x5851F42D4C957F2D)


def thresholds(first: int, ratio: float) -> np.ndarray:
    """Least count of each level."""
    out = [first]
    while out[-1] < 1 << 48:
        out.append(max(out[-1] + 1, int(np.ceil(out[-1] * ratio))))
    return np.array(out, dtype=np.int64)


UNI_LEVELS, PAIR_LEVELS = thresholds(1, UNI_RATIO), thresholds(1, PAIR_RATIO)


def is_held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def tokens_of(text: str | None) -> np.ndarray:
    """Hashes of the words and of the end."""
    return np.append(word_hashes(text), END)


def unigram_keys(tokens: np.ndarray) -> np.ndarray:
    return mix64(tokens ^ _UNIGRAM)


def pair_key(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """``PAIR_BITS`` bits of hash: among 10**11 distinct pairs one key in 3000 is shared, about as
    many as the filter's false positives.  Token keys, whose counts are exact, have 64."""
    return chain64(before, tokens) >> np.uint64(64 - PAIR_BITS)


def pair_keys(tokens: np.ndarray) -> np.ndarray:
    """Key of each token with the one before it (the end before the first)."""
    return pair_key(np.concatenate([[END], tokens[:-1]]).astype(np.uint64), tokens)


def slice_of(keys: np.ndarray, slices: int) -> np.ndarray:
    return ((keys >> np.uint64(24)) % np.uint64(slices)).astype(np.int64)


# --- blocks ---------------------------------------------------------------------------------

#: per document: id, number of tokens, hash of the text, flags (1 held out, 2 null id);
#: the distinct tokens (``words``, by their unigram key) and every token's number among them (``at``)
BLOCKS = "chunk long, ids binary, sizes binary, hashes binary, flags binary, words binary, at binary"


def _packed(x: np.ndarray) -> bytes:
    """An array byte by byte (all first bytes, all second bytes, ...), compressed."""
    return zstandard.ZstdCompressor(1).compress(x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes())


def _unpacked(raw: bytes | None, dtype: str) -> np.ndarray:
    if raw is None:
        return np.empty(0, dtype=dtype)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).reshape(-1)


def _text_hash(text: str | None) -> int:
    return xxhash.xxh3_64_intdigest((text or "").encode("utf-8", "surrogatepass"))


def _block_row(chunk: int, block: list[tuple]) -> tuple:
    docs = [tokens_of(t) for _, t in block]
    words, at = np.unique(np.concatenate(docs), return_inverse=True)
    order = np.argsort(unigram_keys(words))
    place = np.empty(len(order), dtype="<u4")
    place[order] = np.arange(len(order), dtype="<u4")
    return (chunk, np.array([i or 0 for i, _ in block], dtype=np.int64).tobytes(),
            np.fromiter(map(len, docs), dtype="<u4", count=len(docs)).tobytes(),
            np.array([_text_hash(t) for _, t in block], dtype=np.uint64).tobytes(),
            np.array([2 * (i is None) + is_held_out(i) for i, _ in block], dtype=np.uint8).tobytes(),
            words[order].tobytes(), _packed(place[at]))


def block_table(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """The texts as written ``BLOCKS``."""
    def run(batches: Iterator[tuple[list, ...]]) -> Iterator[tuple]:
        base, no, block, size = TaskContext.get().partitionId() << 32, 0, [], 0
        for ids, texts in batches:
            for row in zip(ids, texts):
                block.append(row)
                size += len(row[1] or "")
                if size >= BLOCK_TEXT:
                    yield tuple([x] for x in _block_row(base + no, block))
                    no, block, size = no + 1, [], 0
        if block:
            yield tuple([x] for x in _block_row(base + no, block))

    return materialize(map_batches(docs.select(F.col(id_col).cast("long"), text), BLOCKS, run), "blocks", codec="zstd")


class Block:
    """A row of ``BLOCKS``, read."""

    def __init__(self, sizes: bytes, flags: bytes, words: bytes, at: bytes):
        self.sizes = np.frombuffer(sizes, dtype="<u4").astype(np.int64)
        self.flags = np.frombuffer(flags, dtype=np.uint8)
        self.words = np.frombuffer(words, dtype=np.uint64)
        self.at = _unpacked(at, "<u4")
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.before = np.concatenate([self.at[:1], self.at[:-1]])  # the token before each
        self.before[self.starts] = self.at[self.starts + self.sizes - 1]  # the end, before the first

    def learned(self) -> np.ndarray:
        """Which tokens belong to training rows."""
        return np.repeat(self.flags & 1 == 0, self.sizes)

    def tokens(self) -> np.ndarray:
        """Keys of the distinct tokens, ascending."""
        return unigram_keys(self.words)

    def pairs(self) -> np.ndarray:
        """Key of every token with the one before it."""
        return pair_key(self.words[self.before], self.words[self.at])


def _read_blocks(batches: Iterator[tuple[list, ...]]) -> Iterator[tuple[int, Block]]:
    """Of columns chunk, sizes, flags, words, at."""
    for columns in batches:
        for chunk, *parts in zip(*columns):
            yield chunk, Block(*parts)


_BLOCK = ("chunk", "sizes", "flags", "words", "at")


def _grouped(part: np.ndarray) -> np.ndarray:
    """Stable order of small whole numbers (two bytes are sorted by counting)."""
    return np.argsort(part.astype(np.uint16) if len(part) and part.max() < 1 << 16 else part, kind="stable")


def _deal(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Places of the equal values of ``part``, in order."""
    order = _grouped(part)
    cuts = np.nonzero(np.diff(part[order], prepend=-1))[0]
    for a, b in zip(cuts, [*cuts[1:], len(part)]):
        yield int(part[order[a]]), order[a:b]


def _shrunk(keys: np.ndarray) -> bytes:
    """Ascending keys as differences, whose leading bytes are zeros."""
    return _packed(np.diff(keys, prepend=np.uint64(0)))


def _grown(raw: bytes | None) -> np.ndarray:
    return np.cumsum(_unpacked(raw, "<u8"), dtype=np.uint64)


# --- counting -------------------------------------------------------------------------------

PIECES = "p int, chunk long, tokens binary, n_tokens binary, pairs binary, n_pairs binary"


def _pieces(slices: int):
    """Deal each block's n-grams, with their counts in training rows, to the reducers."""
    def run(batches: Iterator[tuple[list, ...]]) -> Iterator[tuple]:
        for chunk, block in _read_blocks(batches):
            learned, tokens = block.learned(), block.tokens()
            n = np.bincount(block.at[learned], minlength=len(tokens)).astype("<u4")
            rows = {p: [p, chunk, _shrunk(tokens[mine]), _packed(n[mine]), None, None]
                    for p, mine in _deal(slice_of(tokens, slices))}
            pairs, n = np.unique(block.pairs()[learned], return_counts=True)
            n = n.astype("<u4")
            for p, mine in _deal(slice_of(pairs, slices)):
                rows.setdefault(p, [p, chunk, None, None, None, None])[4:] = [_shrunk(pairs[mine]), _packed(n[mine])]
            out = list(rows.values())
            for i in range(0, len(out), 16):
                yield tuple(zip(*out[i:i + 16]))

    return run


# --- the filter -----------------------------------------------------------------------------

def _hashes(keys: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First hash and step of the entries of keys at levels (double hashing)."""
    h = mix64(keys + (levels.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95))
    return h, mix64(h) | np.uint64(1)


def _bit(h: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Place of a hash among ``size`` bits (fewer than 2**32)."""
    return (((h >> np.uint64(32)) * size) >> np.uint64(32)).astype(np.int64)


def build_slice(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """Bits (as bytes) of a slice over (keys, counts, thresholds) parts, at half load."""
    levels = [np.searchsorted(t, c, side="right") for _, c, t in parts]
    entries = int(sum(lv.sum() for lv in levels))
    size = max(64, int(entries * HASHES / np.log(2)) + 7 & ~7)
    bits = np.zeros(size, dtype=bool)
    for (keys, _, _), top in zip(parts, levels):
        level = 0
        while len(keys):
            stay = top > level
            keys, top = keys[stay], top[stay]
            h, step = _hashes(keys, np.array([level]))
            for _ in range(HASHES):
                bits[_bit(h, np.uint64(size))] = True
                h = h + step
            level += 1
    return np.packbits(bits)


class Shard:
    """Some slices of the filter, ready to be probed."""

    def __init__(self, slices: int, held: list[tuple[int, bytes]]):
        self.slices = slices
        self.bits = np.concatenate([np.frombuffer(raw, dtype=np.uint8) for _, raw in held])
        self.start = np.full(slices, -1, dtype=np.int64)
        self.size = np.ones(slices, dtype=np.uint64)
        at = 0
        for p, raw in held:
            self.start[p], self.size[p] = 8 * at, 8 * len(raw)
            at += len(raw)

    def _hits(self, keys: np.ndarray, p: np.ndarray, levels: np.ndarray, hashes: int) -> np.ndarray:
        """Places of the keys whose first ``hashes`` probes at their level all hit."""
        live = np.arange(len(keys))
        h, step = _hashes(keys, levels)
        start, size = self.start[p], self.size[p]
        for left in reversed(range(hashes)):
            at = _bit(h, size) + start
            hit = (self.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
            live = live[hit]
            if left:
                h, step, start, size = (x[hit] for x in (h, step, start, size))
                h += step
        return live

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Highest level whose probes all hit, 0 for none or for a slice held elsewhere.

        A key climbs while ``SCOUTS`` probes of the next level hit; then all probes of the level
        it has reached must hit, or it steps down.  No entry is missed: its probes hit at
        every level up to its own."""
        top = np.zeros(len(keys), dtype=np.uint16)
        p = slice_of(keys, self.slices)
        live = np.nonzero(self.start[p] >= 0)[0]
        live = live[_grouped(p[live])]  # one slice after the other: near in memory
        climbing, level = live, 0
        while len(climbing):
            climbing = climbing[self._hits(keys[climbing], p[climbing], np.array([level]), SCOUTS)]
            level += 1
            top[climbing] = level
        live = live[top[live] > 0]
        while len(live):
            sure = np.zeros(len(live), dtype=bool)
            sure[self._hits(keys[live], p[live], top[live] - 1, HASHES)] = True
            live = live[~sure]
            top[live] -= 1
            live = live[top[live] > 0]
        return top


REDUCED = "p int, chunk long, counts binary, bits binary, n long, v long"


def _reduce(table: pa.Table) -> pa.Table:
    """One reducer's slice, and the counts of every block's tokens in it."""
    p = table["p"][0].as_py()
    chunks, tokens, n_tokens, pairs, n_pairs = (table[c].to_pylist() for c in
                                                ("chunk", "tokens", "n_tokens", "pairs", "n_pairs"))

    def summed(keys: list, counts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        uniq, at = np.unique(np.concatenate([_grown(k) for k in keys]), return_inverse=True)
        n = np.concatenate([_unpacked(c, "<u4") for c in counts]).astype(np.int64)
        count = np.zeros(len(uniq), dtype=np.int64)
        np.add.at(count, at, n)
        return uniq, at, count

    keys, at, count = summed(tokens, n_tokens)
    some = count > 0
    parts = [(keys[some], count[some], UNI_LEVELS)]
    pair_list, _, pair_count = summed(pairs, n_pairs)
    parts.append((pair_list, pair_count, PAIR_LEVELS))
    out, start = [], 0
    for chunk, raw in zip(chunks, n_tokens):
        size = len(_unpacked(raw, "<u4"))
        out.append((p, chunk, _packed(count[at[start:start + size]]), None, None, None))
        start += size
    out.append((p, None, None, build_slice(parts).tobytes(), int(count.sum()), int(some.sum())))
    types = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    return pa.Table.from_arrays([pa.array(v, type=t) for v, t in zip(zip(*out), types)],
                                names=["p", "chunk", "counts", "bits", "n", "v"])


# --- scoring --------------------------------------------------------------------------------

def log10_tokens(uni: np.ndarray, before: np.ndarray, pair: np.ndarray, n: int, v: int) -> np.ndarray:
    """Model log10 probability of tokens from the levels of the token, of the one
    before it and of the pair."""
    low = np.where(uni > 0, UNI_LEVELS[np.maximum(uni, 1) - 1], 0)
    base = (low + 1) / (n + v + 1)
    high = np.where(before > 0, UNI_LEVELS[before] - 1, 0)  # largest count of the level
    c = np.where(pair > 0, PAIR_LEVELS[np.maximum(pair, 1) - 1], 0)
    share = np.where(high > 0, SHARE, 0.0)
    seen = np.minimum(c / np.maximum(high, 1), 1.0)
    return np.log10(share * seen + (1 - share) * base)


#: the counts (by slice) and levels (by shard) of a block's distinct n-grams
ANSWERS = "chunk long, p int, counts binary, k int, tokens binary, pairs binary"
SCORED = ("id long, text_hash long, held_out boolean, n_tokens long, n_known long, gain double, score double")


def _scores(slices: int, shard_of: np.ndarray, n: int, v: int):
    """One block's documents from the block and its answers."""
    def run(key, blocks: pa.Table, answers: pa.Table) -> pa.Table:
        row = {c: blocks[c][0].as_py() for c in blocks.column_names}
        block = Block(row["sizes"], row["flags"], row["words"], row["at"])
        tokens = block.tokens()
        pairs, pair_at = np.unique(block.pairs(), return_inverse=True)
        part = slice_of(tokens, slices)
        held = {"token": dict(_deal(shard_of[part])), "pair": dict(_deal(shard_of[slice_of(pairs, slices)]))}
        by_slice = dict(_deal(part))
        count = np.zeros(len(tokens), dtype=np.int64)
        uni, pair = np.zeros(len(tokens), dtype=np.uint16), np.zeros(len(pairs), dtype=np.uint16)
        for p, counts, k, a, b in zip(*(answers[c].to_pylist() for c in ("p", "counts", "k", "tokens", "pairs"))):
            if k is None:
                if p in by_slice:
                    count[by_slice[p]] = _unpacked(counts, "<i8")
                continue
            if a is not None:
                uni[held["token"][k]] = _unpacked(a, "<u2")
            if b is not None:
                pair[held["pair"][k]] = _unpacked(b, "<u2")
        per_token = log10_tokens(uni[block.at], uni[block.before], pair[pair_at], n, v)
        flags = block.flags

        def total(x: np.ndarray) -> np.ndarray:
            return np.add.reduceat(x, block.starts)

        return pa.table({
            "id": pa.array(np.frombuffer(row["ids"], dtype=np.int64), mask=flags >= 2),
            "text_hash": np.frombuffer(row["hashes"], dtype=np.int64), "held_out": (flags & 1).astype(bool),
            "n_tokens": block.sizes, "n_known": total((count > 0).astype(np.int64)[block.at]),
            "gain": total(np.log10(count + 1.0)[block.at]), "score": total(per_token)})

    return run


class BloomModel:
    """A trained filter: its slices as a table, N and V."""

    def __init__(self, reduced: DataFrame, slices: int):
        self.reduced, self.slices = reduced, slices
        stats = reduced.filter("bits IS NOT NULL")
        self.n, self.v = (int(x or 0) for x in stats.agg(F.sum("n"), F.sum("v")).first())
        self.bytes = {r["p"]: r["bytes"] for r in stats.select("p", F.octet_length("bits").alias("bytes")).collect()}

    def shards(self, limit: int) -> list[list[int]]:
        """Slices in groups of at most ``limit`` bytes (a larger slice is a group alone)."""
        groups: list[list[int]] = [[]]
        size = 0
        for p in sorted(self.bytes):
            if groups[-1] and size + self.bytes[p] > limit:
                groups.append([])
                size = 0
            groups[-1].append(p)
            size += self.bytes[p]
        return groups if groups[-1] else []

    def load(self, group: list[int]) -> Shard:
        rows = self.reduced.filter(F.col("bits").isNotNull() & F.col("p").isin(group)).select("p", "bits").collect()
        return Shard(self.slices, [(r["p"], bytes(r["bits"])) for r in rows])

    def _levels(self, blocks: DataFrame, groups: list[list[int]], shard_of: np.ndarray) -> DataFrame:
        """(chunk, tokens, pairs, k): levels of the distinct n-grams of each block and shard, in
        the order of their keys; written shard by shard."""
        slices, spark = self.slices, blocks.sparkSession

        def by_shard(batches: Iterator[tuple[list, ...]]) -> Iterator[tuple]:
            for chunk, block in _read_blocks(batches):
                tokens, pairs = block.tokens(), np.unique(block.pairs())
                rows: dict[int, list] = {}
                for place, keys in ((2, tokens), (3, pairs)):
                    for k, mine in _deal(shard_of[slice_of(keys, slices)]):
                        rows.setdefault(k, [chunk, k, None, None])[place] = _shrunk(keys[mine])
                for row in rows.values():
                    yield tuple([x] for x in row)

        schema = "chunk long, k int, tokens binary, pairs binary"
        keys = map_batches(blocks.select(*_BLOCK), schema, by_shard)
        if len(groups) > 1:
            keys = materialize(keys, "ngrams", ("k",), codec="zstd")
        path = shared_path(spark, "wideloom-llm", f"levels-{uuid.uuid4().hex}")
        for k, group in enumerate(groups):
            held = spark.sparkContext.broadcast(self.load(group))

            def probe(batches: Iterator[tuple[list, ...]], held=held) -> Iterator[tuple]:
                for chunks, tokens, pairs in batches:
                    for row in zip(chunks, tokens, pairs):
                        yield ([row[0]], *([None if x is None else _packed(held.value.levels(_grown(x)))] for x in row[1:]))

            mine = keys.filter(F.col("k") == k).select("chunk", "tokens", "pairs")
            (map_batches(mine, "chunk long, tokens binary, pairs binary", probe)
             .write.option("compression", "zstd").parquet(f"{path}/k={k}"))
            held.destroy()
        return spark.read.schema("chunk long, tokens binary, pairs binary, k int").parquet(path)

    def score_blocks(self, blocks: DataFrame, counts: bool, limit: int = MAX_BROADCAST) -> DataFrame:
        """``SCORED`` for every row of the blocks; the base figures (``n_known``, ``gain``) only
        with ``counts``, for the blocks that the model was trained from."""
        spark, groups = blocks.sparkSession, self.shards(limit)
        if not groups:  # an empty table
            return spark.createDataFrame([], SCORED)
        shard_of = np.zeros(self.slices, dtype=np.int64)  # a slice without n-grams is asked nothing
        for k, group in enumerate(groups):
            shard_of[group] = k
        answers = (self._levels(blocks, groups, shard_of)
                   .selectExpr("chunk", "CAST(NULL AS INT) AS p", "CAST(NULL AS BINARY) AS counts", "k", "tokens", "pairs"))
        if counts:
            answers = answers.unionByName(self.reduced.filter("chunk IS NOT NULL").selectExpr(
                "chunk", "p", "counts", "CAST(NULL AS INT) AS k", "CAST(NULL AS BINARY) AS tokens",
                "CAST(NULL AS BINARY) AS pairs"))
        return (blocks.groupBy("chunk").cogroup(answers.groupBy("chunk"))
                .applyInArrow(_scores(self.slices, shard_of, self.n, self.v), SCORED))

    def score(self, docs: DataFrame, id_col: str, text: str, limit: int = MAX_BROADCAST) -> DataFrame:
        """``(id, text_hash, score)`` for every row of any documents."""
        return (self.score_blocks(block_table(docs, id_col, text), False, limit)
                .select("id", "text_hash", "score"))


def train_blocks(blocks: DataFrame, text_bytes: int) -> BloomModel:
    """The model of the training rows of ``blocks``."""
    slices = max(8, -(-text_bytes // REDUCER_TEXT))
    pieces = map_batches(blocks.select(*_BLOCK), PIECES, _pieces(slices))
    return BloomModel(materialize(pieces.groupBy("p").applyInArrow(_reduce, REDUCED), "reduced", codec="zstd"), slices)


def train(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> tuple[BloomModel, DataFrame]:
    """The model of the training rows, and the blocks of all rows."""
    blocks = block_table(docs, id_col, text)
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return train_blocks(blocks, size), blocks


def op1_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, blocks = train(read_table(spark, sf_dir, "documents"))
    return (model.score_blocks(blocks, True)
            .select(F.col("id").alias("doc_id"), "held_out", "n_tokens", "n_known",
                    F.lit(model.n).cast("long").alias("train_tokens"),
                    (F.col("gain") - F.col("n_tokens") * F.lit(float(np.log10(model.n + model.v + 1)))).alias("base_score"),
                    "score"))
