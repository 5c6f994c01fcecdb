import random
import zlib
from collections import defaultdict

from practica.llm import sharding


def exact_capacity(sizes, shards):
    low, high = max([*sizes, -(-sum(sizes) // shards)]), sum(sizes)
    while low < high:
        mid, used, room = (low + high) // 2, 1, 0
        room = mid
        for s in sizes:
            if s > room:
                used, room = used + 1, mid
            room -= s
        low, high = (low, mid) if used <= shards else (mid + 1, high)
    return low


class FakeEnds(sharding.EndPositions):
    """Bounds over a list instead of a table."""

    def __init__(self, ends, width):
        self.points, self.total, self.touched = ends, ends[-1], set()
        self.segments = self.blocks(ends, width)
        self._index()

    @staticmethod
    def blocks(ends, width):
        by = defaultdict(list)
        for e in ends:
            by[e // width].append(e)
        return sorted((sharding.Segment(min(b), max(b), max(0, len(b) - 2)) for b in by.values()),
                      key=lambda s: s.first)

    def refine(self, which):
        which = {i for i in which if self.segments[i].inner}
        inside = [e for e in self.points if any(self.segments[i].first <= e <= self.segments[i].last for i in which)]
        kept = [s for i, s in enumerate(self.segments) if i not in which]
        self.segments = sorted(kept + [sharding.Segment(e, e, 0) for e in inside], key=lambda s: s.first)
        self._index()


def test_capacity_and_cuts_against_plain_search():
    rng = random.Random(1)
    for _ in range(200):
        sizes = [rng.choice([1, 2, 5, rng.randrange(1, 400)]) for _ in range(rng.randrange(1, 120))]
        shards = rng.choice([2, 3, 16])
        ends = [sum(sizes[:i + 1]) for i in range(len(sizes))]
        capacity, cuts = sharding.minimax_cuts(FakeEnds(ends, rng.choice([1, 7, 50, 1000])), shards, max(sizes))
        assert capacity == exact_capacity(sizes, shards)
        edges = [0, *cuts, ends[-1]]
        assert edges == sorted(edges) and set(cuts) <= {0, *ends}
        assert max(b - a for a, b in zip(edges, edges[1:])) <= capacity


def check(found, docs):
    data = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = sorted((i is None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in data)
    got = found.collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r["size"], r.text_crc32) for r in got) == want
    shard_of, slots = defaultdict(set), defaultdict(list)
    for r in got:
        shard_of[r.text_crc32, r["size"]].add(r.shard)
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 16
    assert all(len(s) == 1 for s in shard_of.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return got


def test_odd_documents(odd_docs):
    check(sharding.shard_documents(odd_docs), odd_docs)


def test_refined_search_gives_the_same(odd_docs, monkeypatch):
    whole = {tuple(r) for r in sharding.shard_documents(odd_docs).collect()}
    monkeypatch.setattr(sharding, "BLOCKS", 3)
    monkeypatch.setattr(sharding, "EXACT_POINTS", 4)
    assert {tuple(r) for r in sharding.shard_documents(odd_docs).collect()} == whole


def test_empty(no_docs):
    assert sharding.shard_documents(no_docs).count() == 0
