import os
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers

from parcelflow.llm.packing import pack, piece_bounds, plan_best_fit

from .cases import SCHEMA, documents

os.environ["TOKENIZERS_PARALLELISM"] = "false"


def test_pieces_are_those_of_tokenizers(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    rows = documents() + [(5000, "<|endoftext|> x", *[None] * 7)]
    want = []
    for r in rows:
        ids = np.array([*t.encode(r[1] or "", add_special_tokens=False).ids, 2], "<u4")
        want += [(r[0], k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(piece_bounds(len(ids), 1024))]
    got = pack(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(repr(tuple(r)[:5]) for r in got) == sorted(map(repr, want))
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) <= 1.05 * sum(w[3] for w in want) / 1024 + 2


def test_plan_places_every_piece_once_and_tightly():
    for seed in range(30):
        rng = random.Random(seed)
        size = rng.choice([7, 64, 1024])
        histogram = {rng.randint(1, size): rng.randint(1, 40) for _ in range(rng.randint(1, 60))}
        used = defaultdict(list)
        seen = defaultdict(set)
        for length, low, high, first, each, place in plan_best_fit(histogram, size):
            for rank in range(low, high):
                assert rank not in seen[length]
                seen[length].add(rank)
                used[first + (rank - low) // each].append((place + (rank - low) % each * length, length))
        assert {k: len(v) for k, v in seen.items()} == histogram
        for pieces in used.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            assert at <= size
        # the same number of sequences as best fit decreasing, piece by piece
        room = []
        for length in sorted(histogram, reverse=True):
            for _ in range(histogram[length]):
                fits = [i for i, r in enumerate(room) if r >= length]
                if fits:
                    room[min(fits, key=lambda i: room[i])] -= length
                else:
                    room.append(size - length)
        assert len(used) == len(room)


def test_empty(spark):
    assert pack(spark.createDataFrame([], SCHEMA)).count() == 0


def test_piece_bounds():
    assert piece_bounds(1, 4) == [(0, 1)] and piece_bounds(4, 4) == [(0, 4)] and piece_bounds(9, 4) == [(0, 1), (1, 4), (5, 4)]
