"""SentencePiece encoding and decoding on the ``tokenizers`` library.

``rebuild`` reads the model protobuf and builds the same tokenizer: the
normaliser (its precompiled character map, extra white space, dummy prefix), the
white-space marker, the model (unigram with its scores, or BPE with its merges
ordered by score) and byte fallback; and the decoder that undoes them.

A BPE or unigram piece never joins a solid character to a following marker
unless the vocabulary has such a piece, so where it has none, a normalised text
is cut before every marker that follows a solid character, and each part is
encoded once per worker.  Checks and decoding run on several threads (``threads_of``).  Every document is verified as a whole: ``parity`` says that its ids
are those which the ``sentencepiece`` library gives for the raw text, ``round_trip`` that
decoding them gives the raw text back.

Edge cases: a null text has null ids, no verdicts and 0 counts; an empty text has no
ids and is at par; repeated rows are alike; empty input, no rows.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import Parts
from .common import map_batches, read_table

THREADS = 2       # per task at least, or as many as spark.task.cpus
CACHE = 500_000   # parts a worker remembers
MARK = "▁"


def read_model(raw: bytes):
    from sentencepiece import sentencepiece_model_pb2 as pb
    model = pb.ModelProto()
    model.ParseFromString(raw)
    return model


def merges_of(pieces: list[tuple[str, float]], vocab: dict[str, int]) -> list[tuple[str, str]]:
    """Merges of a BPE model: every split of a piece into two pieces, best
    scores first."""
    rank = {}
    for piece, score in pieces:
        for i in range(1, len(piece)):
            left, right = piece[:i], piece[i:]
            if left in vocab and right in vocab:
                rank[left, right] = (-score, vocab[left], vocab[right])
    return sorted(rank, key=rank.__getitem__)


def rebuild(raw: bytes):
    """The tokenizer of a serialised model, one that decodes ids without byte pieces
    with fewer steps, and the normaliser apart."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers
    m = read_model(raw)
    spec, norm = m.trainer_spec, m.normalizer_spec
    pieces = [(p.piece, p.score) for p in m.pieces]
    vocab = {p: i for i, (p, _) in enumerate(pieces)}
    unk = next(i for i, p in enumerate(m.pieces) if p.type == 2)
    plain = [(p.piece, p.score) for p in m.pieces if p.type in (1, 4)]  # normal and user-defined pieces
    if spec.model_type == 1:
        model = models.Unigram(pieces, unk_id=unk, byte_fallback=spec.byte_fallback)
    elif spec.model_type == 2:
        model = models.BPE(vocab, merges_of(plain, vocab), unk_token=pieces[unk][0], fuse_unk=True,
                           byte_fallback=spec.byte_fallback)
    else:
        raise ValueError("only unigram and BPE models are supported")
    tokenizer = Tokenizer(model)
    steps = []
    if norm.precompiled_charsmap:
        steps.append(normalizers.Precompiled(norm.precompiled_charsmap))
    if norm.remove_extra_whitespaces:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
    normalizer = normalizers.Sequence(steps)
    strip = [decoders.Strip(" ", 1, 0)] if norm.add_dummy_prefix else []
    tokenizer.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *strip])
    cuttable = not any(re.search(rf"[^{MARK}]{MARK}", p) for p, _ in plain)
    plain = Tokenizer(model)
    plain.decoder = decoders.Sequence([decoders.Fuse(), decoders.Replace(MARK, " "), *strip])
    return tokenizer, plain, normalizer, bool(norm.add_dummy_prefix), cuttable


def threads_of(df: DataFrame) -> int:
    return max(THREADS, int(df.sparkSession.conf.get("spark.task.cpus", "1")))


class Rebuilt:
    _open: dict[str, "Rebuilt"] = {}

    @classmethod
    def open(cls, path: str, threads: int = THREADS) -> "Rebuilt":
        if path not in cls._open:
            with open(path, "rb") as f:
                cls._open[path] = cls(f.read(), threads)
        return cls._open[path]

    def __init__(self, raw: bytes, threads: int = THREADS):
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        import sentencepiece
        self.threads = threads
        self.tokenizer, self.plain, self.normalizer, self.prefix, self.cuttable = rebuild(raw)
        self.original = sentencepiece.SentencePieceProcessor(model_proto=raw)
        self.model = self.tokenizer.model
        pieces = [p.piece for p in read_model(raw).pieces]
        self.raw = [i.to_bytes(4, "little") for i in range(len(pieces))]
        self.byte_ids = frozenset(i for i, p in enumerate(pieces) if re.fullmatch("<0x[0-9A-Fa-f]{2}>", p))
        self.parts = re.compile(rf"{MARK}*[^{MARK}]+|{MARK}+")
        self.cache = Parts(self.part, CACHE)

    def normalise(self, text: str) -> str:
        text = self.normalizer.normalize_str(text)
        if not text:
            return ""
        return ((" " if self.prefix else "") + text).replace(" ", MARK)

    def encode_many(self, texts: list[str | None]) -> list[tuple[bytes | None, bool | None, bool | None]]:
        """Ids (little-endian 32-bit), parity and round trip of each text."""
        coded = self.ids_many(texts)
        known = [(t, x) for t, x in zip(texts, coded) if t is not None]
        want = self.original.encode([t for t, _ in known], num_threads=self.threads) if known else []
        par = [np.array(w, dtype="<u4").tobytes() == x for w, (_, x) in zip(want, known)]
        rows = [w if p else np.frombuffer(x, dtype="<u4").tolist() for w, p, (_, x) in zip(want, par, known)]
        back = self.decode_ids(rows)
        checked = iter([(x, p, b == t) for (t, x), p, b in zip(known, par, back)])
        return [(None, None, None) if t is None else next(checked) for t in texts]

    def part(self, part: str) -> bytes:
        """Ids of a part that the cache lacks; the tokenizer has no step before its model."""
        return b"".join([self.raw[t.id] for t in self.model.tokenize(part)])

    def cut(self, normal: str) -> list[str]:
        if not normal or not self.cuttable:
            return [normal] if normal else []
        if MARK + MARK in normal or "\0" in normal:
            return self.parts.findall(normal)
        parts = normal.replace(MARK, "\0" + MARK).split("\0")
        return parts if parts[0] else parts[1:]

    def ids_many(self, texts: list[str | None]) -> list[bytes | None]:
        return [None if t is None else b"".join(map(self.cache.__getitem__, self.cut(self.normalise(t)))) for t in texts]

    def decode_ids(self, rows: list[list[int]]) -> list[str]:
        """Texts of id lists; byte pieces, which the plain decoder leaves as they are, are looked for in each."""
        plain = [self.byte_ids.isdisjoint(r) for r in rows]
        some = iter(self.plain.decode_batch([r for r, p in zip(rows, plain) if p], skip_special_tokens=False))
        rest = iter(self.tokenizer.decode_batch([r for r, p in zip(rows, plain) if not p], skip_special_tokens=False))
        return [next(some if p else rest) for p in plain]

    def decode_many(self, ids: list[bytes | None]) -> list[str | None]:
        rows = [[] if x is None else np.frombuffer(x, dtype="<u4").tolist() for x in ids]
        return [None if x is None else t
                for x, t in zip(ids, self.decode_ids(rows))]


def encode(df: DataFrame, id_col: str, text: str, model: str) -> DataFrame:
    """``(id_col, ids, parity, round_trip)``; ``ids`` as little-endian 32-bit
    bytes (``decode`` takes them)."""
    threads = threads_of(df)

    def run(batches: Iterator[tuple[list, ...]]) -> Iterator[tuple]:
        rebuilt = Rebuilt.open(model, threads)
        for ids, texts in batches:
            for s in range(0, len(ids), 512):
                yield (ids[s:s + 512], *zip(*rebuilt.encode_many(texts[s:s + 512])))

    kind = df.schema[id_col].dataType.simpleString()
    return map_batches(df.select(id_col, text), f"`{id_col}` {kind}, ids binary, parity boolean, round_trip boolean", run)


def decode(df: DataFrame, id_col: str, ids: str, model: str) -> DataFrame:
    """``(id_col, text)`` of encoded ids."""
    threads = threads_of(df)

    def run(batches: Iterator[tuple[list, ...]]) -> Iterator[tuple]:
        rebuilt = Rebuilt.open(model, threads)
        for keys, raws in batches:
            for s in range(0, len(keys), 512):
                yield keys[s:s + 512], rebuilt.decode_many(raws[s:s + 512])

    kind = df.schema[id_col].dataType.simpleString()
    return map_batches(df.select(id_col, ids), f"`{id_col}` {kind}, text string", run)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    coded = encode(read_table(spark, sf_dir, "documents"), "doc_id", "text", public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", (F.coalesce(F.octet_length("ids"), F.lit(0)) / 4).cast("long").alias("n_ids"),
                        F.crc32("ids").alias("ids_crc32"), "parity", "round_trip")
