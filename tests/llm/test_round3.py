"""Small tests of round 3."""

from __future__ import annotations

import numpy as np
import public_tokenizers

from wideloom.llm.bpe import ByteBpe
from wideloom.llm.op2_packing import Block, Limits
from wideloom.llm.op4_sentencepiece import Rebuilt


def test_bpe_parts_are_encoded_when_the_cache_lacks_them():
    bpe = ByteBpe(public_tokenizers.path("byte_bpe_50k.json"))
    for part in [" blewh", "blewh.", " élan,", "\nx1", " .", " don't", "a"]:
        assert bpe.cache[part] == bpe.whole(part)
    assert {" blewh", "blewh", "."} <= bpe.cache.keys()


def test_best_is_the_first_of_the_largest_products():
    rng = np.random.default_rng(3)
    limits = Limits()
    for cut in (False, True):
        tokens = rng.integers(0, 1100, 300)
        loss = tokens if cut else tokens // 2
        block, cap = Block(tokens, loss, limits, cut), limits.vector()
        rows = np.stack([tokens, np.ones(300), loss], axis=1)
        for room in ([1024, 256, 1024], [300, 2, 40], [0, 0, 0]):
            fits = (rows <= room).all(axis=1)
            score = np.where(fits, (rows / cap * (np.array(room) / cap)).sum(axis=1), -1)
            want = int(score.argmax()) if fits.any() else -1
            got = block.best(np.array(room, dtype=float))
            assert (got == want) or (want >= 0 and (rows[got] == rows[want]).all() and got < want)
    assert len(block.demand) == 3  # a column per limit


def test_pieces_are_cut_and_decoded_as_by_the_whole_tokenizer():
    r = Rebuilt.open(public_tokenizers.path("piece_bpe_32k.model"))
    texts = ["a plain text", "a▁b", "a  b ", "Δ\U0001f9ff odd\0x", "", " ▁ ▁▁x", "one\ntwo\tthree"]
    normal = [r.normalise(t) for t in texts] + ["▁▁a▁", "a▁b▁", "a\0▁b", "▁"]
    for n in normal:
        assert r.cut(n) == r.parts.findall(n)
        assert b"".join(r.cache[p] for p in r.cut(n)) == np.array(
            r.tokenizer.encode(n, add_special_tokens=False).ids, dtype="<u4").tobytes()
    rows = r.original.encode(texts) + [sorted(r.byte_ids), []]
    assert r.decode_ids(rows) == r.tokenizer.decode_batch(rows, skip_special_tokens=False)
