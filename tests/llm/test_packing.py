import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from funnelforge.llm import packing


def check(rows, docs):
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for doc_id, text in docs:
        ids = reference.encode(text or "", add_special_tokens=False).ids + [0]
        first = len(ids) if len(ids) <= 2048 else len(ids) % 2048
        cuts = [0, *([first] if first else []), *range(first + 2048, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.append((doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == sorted(want, key=repr)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return len(by_sequence), -(-sum(w[3] for w in want) // 2048)


def test_pieces_and_places(frame):
    rnd = random.Random(2)
    docs = [(i, " ".join(rnd.choices(["the", "Überraschung", "x9", "<|endoftext|>", "\n\n"], k=rnd.randrange(900))))
            for i in range(60)]
    docs += [(70, None), (71, ""), (72, "token " * 9000), (72, "token " * 9000), (None, "a"), (73, " " * 600_000),
             (74, "a" * 2047), (75, "word " * 4095)]
    packed = packing.pack_documents(frame([(a, b, 1) for a, b in docs], "doc_id bigint, text string, offset int"))
    used, least = check(packed.collect(), docs)
    assert used <= least + 1
    assert packing.pack_documents(frame([], "doc_id bigint, text string")).collect() == []


def test_plan_uses_all_counts():
    rnd = random.Random(7)
    for size, top in ((64, 64), (64, 20), (200, 150)):
        counts = {n: rnd.randrange(1, 500) for n in rnd.sample(range(1, top + 1), min(top, 25))}
        left = dict(counts)
        runs = packing.plan(counts, size)
        for lengths, times in runs:
            assert sum(lengths) <= size and times > 0
            for n in lengths:
                left[n] -= times
        assert not any(left.values())
        if top <= size // 3:
            assert sum(t for _, t in runs) <= -(-sum(n * c for n, c in counts.items()) // size) + 1
