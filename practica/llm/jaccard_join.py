"""N-gram Jaccard join with a MinHash LSH forest and exact verification.

Similarity is the Jaccard similarity of the sets of five-word shingles (a text
of one to four words is one shingle); texts of at least ``SIMILARITY`` are
linked. Every link between different texts is verified on the whole sets.

Forest: ``TREES`` prefix tries over MinHash signatures of ``DEPTH`` values each.
Texts meet in a node if their values agree as far as the node is deep. Matching
starts with whole signatures (depth ``DEPTH``) and shortens the prefixes level by
level; of each level only nodes whose texts come from two or more nodes below are
looked at, and in them only pairs that met neither in a deeper node nor in the
same depth of an earlier tree. All these pairs are verified. A link of similarity
s is found at depth d or below with probability p = 1 - (1 - s^d)^l for l trees,
so the similarities of the verified links tell how many were missed, n / p - n
for each similarity. Shortening ends when that is at most 1 - ``RECALL`` of all, or at the depth
where it would be even if all links were at the threshold (4 here).

Equal texts are one class from the start (they share a digest), so copies are
never paired. A node with more than ``TILE`` texts or ``TILE_SHINGLES`` shingles
is divided into tiles; each pair of tiles is one unit of work, so no task holds a
node, and shingle sets travel only to units that verify with them. Units give, for each text, how many
rows it is linked to and the smallest text of its local component; no table of
pairs is made. Components are joined by alternating stars.

Result: one row per document with ``class_id`` (smallest id of its component),
``copy_of`` (smallest id with an equal text) and ``n_links`` (other rows, copies
included, at or above the threshold).

Defined results: a null text is the empty text; texts without words are linked
to equal texts only. Repeated rows count as copies. Null ids are larger than
any id; a class of null ids alone has a null class_id. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from practica.llm.common import map_batches, map_sorted_groups, small_side, texts_of, without_rows
from practica.llm.hashing import mix, word_hasher
from practica.session import materialize

WORDS = 5
SIMILARITY = 0.8
TREES, DEPTH = 32, 6
RECALL = 1 - 1e-7
BINS = 20                   # classes of similarity of verified links
TILE, TILE_SHINGLES = 2048, 2_000_000
BLOCK = 512                 # texts compared with all of their unit at a time
SEED = 5
NODE_BYTES = 40             # of a node that is broadcast
BROADCAST_BYTES = 32 << 20
UNIT = ["tree", "prefix", "i", "j"]


def chance(similarity: float | np.ndarray, depth: int, trees: int = TREES):
    """Probability that a pair meets in a node of this depth or below."""
    return 1 - (1 - similarity ** depth) ** trees


def least_depth(similarity: float = SIMILARITY, recall: float = RECALL) -> int:
    """The depth at which links at the threshold alone would reach the recall."""
    depth = DEPTH
    while depth > 1 and chance(similarity, depth) < recall:
        depth -= 1
    return depth


def missed_share(found: np.ndarray, depth: int, similarity: float = SIMILARITY) -> float:
    """Expected share of links missed so far, from the numbers found in each
    class of similarity (taken at its lower end) and one more at the threshold."""
    found = found + np.eye(1, BINS)[0]
    p = chance(similarity + (1 - similarity) * np.arange(BINS) / BINS, depth)
    return float(((found / p) * (1 - p)).sum() / (found / p).sum())


def _constants(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes of all texts in order, number for each text); a shingle
    that occurs again in its text is there again."""
    c = _constants(WORDS, SEED)
    ends = np.cumsum(counts)
    n = np.where(counts >= WORDS, counts - WORDS + 1, (counts > 0).astype(counts.dtype))
    if not n.sum():
        return np.zeros(0, np.uint64), n
    # Words past the end of a short text weigh nothing.
    first = np.repeat(ends - counts, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    last = np.repeat(ends, n)
    total = np.zeros(len(first), np.uint64)
    for k in range(WORDS):
        at = first + k
        inside = at < last
        total += np.where(inside, hashes[np.minimum(at, len(hashes) - 1)], np.uint64(0)) * c[k]
    return mix(total), n


def signatures(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """MinHash values of 16 bits, ``TREES`` * ``DEPTH`` for each text with shingles."""
    starts = (np.cumsum(n) - n)[n > 0]
    factor, shift = _constants(TREES * DEPTH, SEED + 1), _constants(TREES * DEPTH, SEED + 2)
    out = np.zeros((len(starts), TREES * DEPTH), np.uint16)
    for k in range(TREES * DEPTH):
        out[:, k] = mix(np.minimum.reduceat(h * factor[k] + shift[k], starts)) >> np.uint64(48)
    return out


def prefixes(signature: np.ndarray) -> np.ndarray:
    """(texts, trees, depth): the hash of each prefix, with its tree."""
    values = signature.reshape(-1, TREES, DEPTH).astype(np.uint64)
    h = np.broadcast_to(_constants(TREES, SEED + 3), values.shape[:2])
    out = np.zeros(values.shape, np.uint64)
    for d in range(DEPTH):
        h = out[:, :, d] = mix(h * np.uint64(3) + (values[:, :, d] + np.uint64(1)) * _constants(1, SEED + 4)[0])
    return out


def signature_of(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """(texts, values) of a column of signatures without nulls."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, TREES * DEPTH)


def sign(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, signature, size): null without words; shingles, repeated
    ones too."""
    def run(batch: pa.RecordBatch) -> dict:
        found: list = []
        sizes: list = []
        for _, hashes, counts in word_hasher().groups(texts_of(batch)):
            h, n = shingles(hashes, counts)
            rows = iter(signatures(h, n) if n.any() else [])
            found += [next(rows).tobytes() if k else None for k in n]
            sizes += n.tolist()
        return {"doc_id": batch.column("doc_id"), "digest": batch.column("digest"),
                "signature": pa.array(found, pa.binary()), "size": pa.array(sizes, pa.int64())}
    return map_batches(docs, run, "doc_id long, digest string, signature binary, size long")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(digest, shingles): the sorted set of each text."""
    def run(batch: pa.RecordBatch) -> dict:
        found = []
        for _, hashes, counts in word_hasher().groups(texts_of(batch)):
            h, n = shingles(hashes, counts)
            found += [np.unique(part).view(np.int64) for part in np.split(h, np.cumsum(n)[:-1])]
        return {"digest": batch.column("digest"), "shingles": pa.array(found, pa.list_(pa.int64()))}
    return map_batches(docs.select("digest", "text"), run, "digest string, shingles array<long>")


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets) of a list column."""
    c = column.combine_chunks()
    c = c.chunk(0) if isinstance(c, pa.ChunkedArray) else c
    sizes = np.diff(c.offsets.to_numpy())
    return c.flatten().to_numpy(), np.concatenate([[0], np.cumsum(sizes)])


def first_meetings(hashes: np.ndarray, tree: int, depth: int) -> np.ndarray:
    """Which pairs of these texts meet at this depth of ``tree`` but in no deeper
    node and in no earlier tree (a symmetric table without the diagonal)."""
    def same(t: int, d: int) -> np.ndarray:
        column = hashes[:, t, d - 1]
        return column[:, None] == column[None, :]
    earlier = ~same(tree, depth)
    for t in range(tree):
        earlier |= same(t, depth)
    for t in range(TREES if depth < DEPTH else 0):
        earlier |= same(t, depth + 1)
    np.fill_diagonal(earlier, True)
    return ~earlier


def _pairs(table: pa.Table, a: int, b: int, hashes: np.ndarray, depth: int) -> np.ndarray:
    """Pairs that the unit in rows a..b verifies: each pair of a node once."""
    tree, i, j = (table.column(c)[a].as_py() for c in ("tree", "i", "j"))
    meet = first_meetings(hashes[a:b], tree, depth)
    if i != j:
        tile = table.column("tile").slice(a, b - a).to_numpy()
        meet &= tile[:, None] != tile[None, :]
    return meet


def nodes_of(classes: DataFrame, depth: int) -> DataFrame:
    """(tree, prefix, child, digest, size): the nodes of this depth that hold each
    text, and the node below, or at the deepest level the text itself."""
    def run(batch: pa.RecordBatch) -> dict:
        h = prefixes(signature_of(batch.column("signature")))
        n = len(h)
        child = (h[:, :, depth] if depth < DEPTH else
                 np.repeat(batch.column("text_hash").to_numpy().view(np.uint64), TREES).reshape(n, TREES))
        return {"tree": pa.array(np.tile(np.arange(TREES, dtype=np.int32), n)),
                "prefix": pa.array(h[:, :, depth - 1].ravel().view(np.int64)),
                "child": pa.array(child.ravel().view(np.int64)),
                **{c: batch.column(c).take(pa.array(np.repeat(np.arange(n), TREES))) for c in ("digest", "size")}}
    signed = classes.filter("signature is not null").select("digest", "size", "signature", F.xxhash64("digest").alias("text_hash"))
    return map_batches(signed, run, "tree int, prefix long, child long, digest string, size long")


def units(classes: DataFrame, depth: int, tile: int) -> DataFrame:
    """(tree, prefix, i, j, tile, digest): texts of every node that joins two or
    more below it, in each pair of tiles that holds theirs."""
    members = nodes_of(classes, depth)
    nodes = materialize(members.groupBy("tree", "prefix")
                        .agg(F.count("*").alias("n"), F.sum("size").alias("size"), F.min("child").alias("a"),
                             F.max("child").alias("b"))
                        .filter("a <> b").select("tree", "prefix", F.greatest(
                            F.ceil(F.col("n") / tile), F.ceil(F.col("size") / TILE_SHINGLES)).cast("int").alias("tiles")),
                        "join_nodes")
    few = nodes.count() * NODE_BYTES <= BROADCAST_BYTES
    both = (members.drop("child", "size").join(F.broadcast(nodes) if few else nodes, ["tree", "prefix"])
            .withColumn("tile", F.pmod(F.xxhash64("digest"), "tiles").cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))))
    return both.select("tree", "prefix", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"),
                       "tile", "digest")


def needed(placed: DataFrame, depth: int) -> DataFrame:
    """The rows of units that verify at least one pair with them."""
    def run(table: pa.Table, starts: list[int]) -> pa.Table:
        hashes = prefixes(signature_of(table.column("signature")))
        keep = np.zeros(table.num_rows, bool)
        for a, b in zip(starts, starts[1:]):
            if b - a > 1:
                keep[a:b] = _pairs(table, a, b, hashes, depth).any(axis=1)
        return table.filter(pa.array(keep))
    return map_sorted_groups(placed, UNIT, run, "tree int, prefix long, i int, j int, tile int, "
                             "digest string, copies long, signature binary")


def common_shingles(values: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Sizes of all pairwise intersections of these sets: (first row, rows of the
    table), ``BLOCK`` rows at a time."""
    m, width = len(offsets) - 1, 4096
    size = np.diff(offsets)
    if m == 2:
        n = len(np.intersect1d(values[:offsets[1]], values[offsets[1]:], assume_unique=True))
        yield 0, np.array([[size[0], n], [n, size[1]]])
        return
    owner = np.repeat(np.arange(m), size)
    _, code, count = np.unique(values, return_inverse=True, return_counts=True)
    # Shingles of one text alone are in no intersection.
    shared = count[code] > 1
    owner, code = owner[shared], (np.cumsum(count > 1) - 1)[code[shared]]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    for begin in range(0, m, BLOCK):
        end = min(begin + BLOCK, m)
        out = np.zeros((end - begin, m), np.float32)
        for first in range(0, int(code[-1]) + 1 if len(code) else 0, width):
            a, b = np.searchsorted(code, [first, first + width])
            table = np.zeros((m, width), np.float32)
            table[owner[a:b], code[a:b] - first] = 1
            out += table[begin:end] @ table.T
        out = out.astype(np.int64)
        out[np.arange(end - begin), np.arange(begin, end)] = size[begin:end]
        yield begin, out


def _roots(links: np.ndarray) -> np.ndarray:
    """Smallest member of each row's component of a symmetric table."""
    root = np.arange(len(links))
    while True:
        low = np.where(links, root[None, :], len(links)).min(axis=1, initial=len(links))
        new = np.minimum(root, low)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


def verify(work: DataFrame, similarity: float, depth: int) -> DataFrame:
    """(digest, links, root, found): linked rows found in a unit, and the smallest
    text of the local component; beside the unit's first text, its links between
    texts in each class of similarity."""
    def run(table: pa.Table, starts: list[int]) -> dict:
        hashes = prefixes(signature_of(table.column("signature")))
        values, offsets = _lists(table.column("shingles"))
        digest, copies = table.column("digest").to_pylist(), table.column("copies").to_numpy()
        out: dict[str, list] = {"digest": [], "links": [], "root": [], "found": []}
        for a, b in zip(starts, starts[1:]):
            if b - a < 2:
                continue
            meet = _pairs(table, a, b, hashes, depth)
            size = np.diff(offsets[a:b + 1])
            found = np.zeros(BINS, np.int64)
            for first, inter in common_shingles(values[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]):
                rows = slice(first, first + len(inter))
                union = size[rows, None] + size[None, :] - inter
                meet[rows] &= inter >= similarity * union - 1e-9
                at = np.nonzero(np.triu(meet[rows], first + 1))
                level = (inter[at] / union[at] - similarity) / max(1 - similarity, 1e-9) * BINS
                found += np.bincount(np.clip(level.astype(np.int64), 0, BINS - 1), minlength=BINS)
            links, found = meet, found.tolist()
            if not links.any():
                continue
            names = digest[a:b]
            order = sorted(range(b - a), key=names.__getitem__)
            root = _roots(links[np.ix_(order, order)])
            weight = links @ copies[a:b]
            for place, k in enumerate(order):
                if weight[k]:
                    out["digest"].append(names[k])
                    out["links"].append(int(weight[k]))
                    out["root"].append(names[order[root[place]]])
                    out["found"].append(found)
                    found = None
        return {"digest": pa.array(out["digest"], pa.string()), "links": pa.array(out["links"], pa.int64()),
                "root": pa.array(out["root"], pa.string()), "found": pa.array(out["found"], pa.list_(pa.int64()))}
    return map_sorted_groups(work, UNIT, run, "digest string, links long, root string, found array<long>")


def links_at(texts: DataFrame, classes: DataFrame, depth: int, similarity: float, tile: int) -> tuple[DataFrame, np.ndarray]:
    """(verified links of one level, their number in each class of similarity)."""
    placed = units(classes, depth, tile).join(classes.select("digest", "copies", "signature"), "digest")
    work = materialize(needed(placed.select(*UNIT, "tile", "digest", "copies", "signature"), depth), "join_units")
    # Shingle sets of the texts that some unit verifies, from one row of each.
    wanted = materialize(work.select("digest").distinct(), "join_wanted")
    chosen = texts.join(small_side(wanted, wanted.count()), "digest", "left_semi")
    sets = materialize(shingle_sets(chosen).dropDuplicates(["digest"]), "join_sets")
    links = materialize(verify(work.join(sets, "digest"), similarity, depth), "join_links")
    found = np.zeros(BINS, np.int64)
    for r in (links.select(F.posexplode("found").alias("k", "n")).groupBy("k").agg(F.sum("n").alias("n")).collect()):
        found[r["k"]] = r["n"]
    return links.drop("found"), found


def forest_links(texts: DataFrame, classes: DataFrame, similarity: float = SIMILARITY, tile: int = TILE,
                 recall: float = RECALL) -> tuple[DataFrame, list[tuple[int, int, float]]]:
    """(links, levels): the levels as (depth, links found, share missed)."""
    least, links, found, levels = least_depth(similarity, recall), None, np.zeros(BINS, np.int64), []
    for depth in range(DEPTH, 0, -1):
        more, n = links_at(texts, classes, depth, similarity, tile)
        links, found = more if links is None else links.unionByName(more), found + n
        levels.append((depth, int(n.sum()), missed_share(found, depth, similarity)))
        if depth <= least or levels[-1][2] <= 1 - recall:
            break
    return links, levels


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v): alternating large and
    small stars until nothing changes; each round is stored."""
    def stars(e: DataFrame, both_ways: bool) -> DataFrame:
        if both_ways:
            e = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = e.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        near = e.join(least, "u")
        if both_ways:
            return near.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))

    def tidy(e: DataFrame) -> DataFrame:
        return materialize(e.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                           .distinct(), "stars")

    def mark(e: DataFrame):
        return e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()

    edges = tidy(edges)
    while True:
        new = tidy(stars(tidy(stars(edges, True)), False))
        if mark(new) == mark(edges):
            return new.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                new.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        edges = new


def link_documents(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id",
                   text_col: str = "text", tile: int = TILE) -> DataFrame:
    """doc_id, class_id, copy_of, n_links, digest for every row."""
    texts = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
             .withColumn("digest", F.md5("text")))
    rows = materialize(sign(texts), "join_rows")
    classes = materialize(rows.groupBy("digest").agg(F.min("doc_id").alias("copy_of"), F.count("*").alias("copies"),
                                                     F.first("signature").alias("signature"),
                                                     F.first("size").alias("size")), "join_classes")
    found, _ = forest_links(texts, classes, similarity, tile)

    links = found.groupBy("digest").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("digest").alias("u"), F.col("root").alias("v")))
    classes = (classes.select("digest", "copy_of", "copies").join(links, "digest", "left")
               .join(roots.withColumnRenamed("node", "digest"), "digest", "left")
               .withColumn("root", F.coalesce("root", "digest")))
    least = classes.groupBy("root").agg(F.min("copy_of").alias("class_id"))
    classes = classes.join(least, "root").select(
        "digest", "class_id", "copy_of", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return (rows.select("doc_id", "digest").join(classes, "digest")
            .select("doc_id", "class_id", "copy_of", F.col("n_links").cast("long").alias("n_links"), "digest"))


def keep_one(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs`` with the first document of each class, all columns."""
    linked = materialize(link_documents(docs, similarity, id_col, text_col), "join_result")
    # One (id, digest) for each class: ids before null, then the smaller digest.
    first = (linked.groupBy("class_id", F.when(F.col("class_id").isNull(), F.col("digest")).alias("_alone"))
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "digest")).alias("k"),)
             .select(F.col("k.doc_id").alias("doc_id"), F.col("k.digest").alias("digest")))
    same = [F.col("a.digest") == F.col("b.digest"), F.col("a.doc_id").eqNullSafe(F.col("b.doc_id"))]
    gone = materialize(linked.select("doc_id", "digest").alias("a").join(first.alias("b"), same, "left_anti")
                       .select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).distinct(), "join_gone")
    again = materialize(linked.groupBy("doc_id", "digest").count().filter("count > 1")
                        .select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")), "join_again")
    keyed = docs.withColumns({"_id": F.col(id_col).cast("long"),
                              "_digest": F.md5(F.coalesce(F.col(text_col), F.lit("")))})
    kept = without_rows(keyed, gone, ["_id", "_digest"])
    if again.isEmpty():
        return kept.drop("_id", "_digest")
    repeated = [F.col("here._id").eqNullSafe(F.col("again._id")), F.col("here._digest") == F.col("again._digest")]
    twice = kept.alias("here").join(again.alias("again"), repeated, "left_semi").dropDuplicates(["_id", "_digest"])
    return without_rows(kept, again, ["_id", "_digest"]).unionByName(twice).drop("_id", "_digest")
