import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from practica.llm import packing, tokens


def fewest(items, size):
    items, best = sorted(items, reverse=True), [len(items)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in {b: k for k, b in enumerate(bins)}.values():
            if bins[k] + items[i] <= size:
                place(i + 1, [*bins[:k], bins[k] + items[i], *bins[k + 1:]])
        place(i + 1, [*bins, items[i]])
    place(0, [])
    return best[0]


def test_bin_completion_is_optimal_on_small_cases():
    rng = random.Random(2)
    for _ in range(150):
        size = rng.randrange(10, 40)
        items = [rng.randrange(1, size + 1) for _ in range(rng.randrange(0, 10))]
        counts = np.bincount(items, minlength=size + 1) if items else np.zeros(size + 1, int)
        packed = packing.pack_counts(counts, size)
        used = np.zeros(size + 1, int)
        for filling, n in packed:
            assert sum(filling) <= size
            for i in filling:
                used[i] += n
        assert (used == counts).all()
        assert packing.lower_bound(counts, size) <= sum(n for _, n in packed) == fewest(items, size)


def test_fillings_are_all_undominated_ones():
    rng = random.Random(9)
    for _ in range(60):
        size = rng.randrange(8, 30)
        items = [rng.randrange(1, size // 2 + 1) for _ in range(rng.randrange(1, 8))]
        largest, rest = max(items), sorted(items)[:-1]
        counts = np.bincount(rest, minlength=size + 1)
        every = {tuple(sorted((v for k, v in enumerate(rest) if m >> k & 1), reverse=True)) for m in range(1 << len(rest))}
        every = {f for f in every if sum(f) <= size - largest}
        got = list(packing.fillings(counts, largest, size))
        assert len(got) == len(every) and {f for _, f in got if f is not None} <= every
        assert all(w == size - largest - sum(f) for w, f in got if f is not None) and got[0][1] is not None
        assert [w for w, _ in got] == sorted(w for w, _ in got)


def test_short_pieces_fill_sequences_of_five_and_more():
    rng = np.random.default_rng(3)
    for low, high, over in ((200, 255, 1.096), (150, 250, 1.025), (100, 255, 1.005), (60, 200, 1.001)):
        counts = np.bincount(rng.integers(low, high + 1, 200_000), minlength=1025)
        used = sum(n for _, n in packing.pack_counts(counts))
        assert used <= over * packing.lower_bound(counts, 1024)
        assert used < sum(n for _, n in packing.best_fit_decreasing(counts, 1024))


def test_ids_equal_the_tokenizers_library():
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "\n\n", "\t", "a", "Word", "'s", "é", "ñ", "12", "!!", "\x85", "\r\n", "<|endoftext|>",
             "日本", "🙂", "'ll", " x", "　"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(12))) for _ in range(3000)]
    ids = tokens.encoder(tokens.vocabulary_path())
    for text, known in zip(texts, plain.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(ids(text), "<u4").tolist() == known.ids


def test_added_tokens_have_the_ids_of_the_json_form(spark):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(6)
    parts = [" ", "  ", "\n", "a", "Word", "'s", "é", "12", "<|endoftext|>", "<|endoftext", "|>", "日本", "　"]
    texts = ["a <|endoftext|> b", *("".join(rng.choices(parts, k=rng.randrange(12))) for _ in range(2000))]
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert want[0] == [64, 220, 50256, 275]
    ids = tokens.encoder(tokens.vocabulary_path(), tokens.added_tokens())
    assert [np.frombuffer(ids(t), "<u4").tolist() for t in texts] == want
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.length, r.ids_crc32) for r in packing.token_pieces(docs).collect()}
    assert got == {i: (len(w) + 1, zlib.crc32(np.array([*w, 2], "<u4").tobytes())) for i, w in enumerate(want)}


def test_every_piece_has_its_place(odd_docs):
    got = packing.pack_documents(odd_docs).collect()
    ids = tokens.encoder(tokens.vocabulary_path())
    want = []
    for r in odd_docs.select("doc_id", "text").collect():
        data = ids(r.text or "") + (2).to_bytes(4, "little")
        n = len(data) // 4
        first = n if n <= 1024 else n % 1024 or 1024
        cuts = [0, *range(first, n + 1, 1024)]
        want += [(r.doc_id or -1, k, a, b - a, zlib.crc32(data[4 * a:4 * b])) for k, (a, b) in
                 enumerate(zip(cuts, cuts[1:]))]
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) <= -(-sum(r.length for r in got) // 1024) + 1


def test_empty(no_docs):
    assert packing.pack_documents(no_docs).count() == 0
