"""SentencePiece encoding and decoding through a table of distinct chunks.

A text, its spaces written as whitespace markers and one marker put before it,
is a sequence of chunks: runs of markers with what follows up to the next
marker. No piece of the model holds a marker behind another character, so no
piece crosses from one chunk into the next and each distinct chunk needs to be
segmented once, wherever it stands. (Line feeds divide chunks too if no piece
holds one.) ``Chunks`` refuses a model for which that can't be shown.

The distinct chunks of all documents are counted. The table of the most frequent
ones, as many as fit in ``HEAD_BYTES``, is segmented by the library once and goes
to every task, which joins its ids to the texts by position; texts don't move. A
chunk beyond it is rarer than all in the table (most stand once in all texts)
and is segmented where it stands, once for each ``HELD`` of them in a task:
sending such chunks to the rest of the table and their ids back to the documents
by position needs several times the input in shuffles.

Result: one row per document with ``n_tokens``, and SHA-256 of the decimal ids
joined by commas and of the decoded text (``digest_documents``), or the ids and
the text themselves (``encode_documents``).

Defined results: a null text is the empty text, which has no ids and decodes to
itself. Long texts and long chunks are encoded whole. Repeated rows are encoded
each. A null id is kept. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from practica.llm.common import SLICE_ROWS, map_batches, release_memory, texts_of
from practica.llm.tokens import vocabulary_path, worker_cache
from practica.session import materialize

MODEL = "piece_bpe_32k.model"
MARKER = "▁"
HEAD_BYTES = 3_000_000      # of chunks; with ids, as objects, about 30 times that in a task
HELD = 60_000               # distinct chunks that a task holds at a time, beside the table


class Chunks:
    """Chunks of texts, and the library's ids and decoded text of a chunk."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        spec = proto.normalizer_spec
        plain = [p.piece for p in proto.pieces if p.type not in (2, 3, 6)]      # no unknown, control, byte
        if (len(spec.precompiled_charsmap) or not spec.add_dummy_prefix or spec.remove_extra_whitespaces
                or not spec.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix):
            raise ValueError("the model changes texts before it divides them")
        if any(MARKER in p.lstrip(MARKER) for p in plain):
            raise ValueError("a piece of the model crosses a whitespace marker")
        lines = not any("\n" in p for p in plain)
        self.find = re.compile("(?: +|\n+)[^ \n]*" if lines else " +[^ ]*").findall
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.marker = self.model.piece_to_id(MARKER)

    def of(self, text: str) -> list[str]:
        return self.find(" " + text.replace(MARKER, " ")) if text else []

    def ids(self, chunk: str) -> list[int]:
        """Ids of a chunk as it stands inside a text."""
        if chunk[0] != " ":                 # a line feed: the library puts a marker before it
            return self.model.encode(chunk)[1:]
        return self.model.encode(chunk[1:]) if len(chunk) > 1 else [self.marker]

    def text(self, ids: list[int], chunk: str) -> str:
        """Those ids decoded; the library takes away a first marker."""
        return " " * (chunk[0] == " ") + self.model.decode(ids)


def chunks_of(path: str) -> Chunks:
    """The process's model."""
    made = worker_cache().__dict__.setdefault("piece_models", {})
    if path not in made:
        made[path] = Chunks(path)
    return made[path]


def count_chunks(texts: DataFrame, path: str) -> DataFrame:
    """(chunk, n) of the column ``text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"chunk": pa.array(list(seen), pa.string()),
                                               "n": pa.array(list(seen.values()), pa.int64())})
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                for text in texts_of(batch.slice(at, SLICE_ROWS)):
                    seen.update(chunks_of(path).of(text))
                    if len(seen) >= HELD:
                        yield out()
                        seen.clear()
            del batch
        yield out()
        release_memory()

    return texts.select("text").mapInArrow(run, "chunk string, n long").groupBy("chunk").agg(F.sum("n").alias("n"))


def segment_chunks(chunks: DataFrame, path: str) -> DataFrame:
    """(chunk, ids, decoded): ids as decimal numbers joined by commas;
    ``decoded`` null where it is the chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [segmented(chunks_of(path), c) for c in batch.column("chunk").to_pylist()]
            yield pa.RecordBatch.from_pydict({"chunk": batch.column("chunk"),
                                              "ids": pa.array([f[0] for f in found], pa.string()),
                                              "decoded": pa.array([f[1] for f in found], pa.string())})
    return chunks.select("chunk").mapInArrow(run, "chunk string, ids string, decoded string")


def segmented(model: Chunks, chunk: str) -> tuple[str, str | None]:
    ids = model.ids(chunk)
    text = model.text(ids, chunk)
    return ",".join(map(str, ids)), None if text == chunk else text


def head_least(counts: DataFrame, limit: int = HEAD_BYTES) -> int:
    """The least count such that the chunks which reach it fit in ``limit``
    bytes. Counts go by powers of two and their quarters: few rows."""
    power = F.floor(F.log2("n"))
    step = F.floor(F.col("n") / F.pow(F.lit(2.0), power - 2)) * F.pow(F.lit(2.0), power - 2)
    held, least = 0, 1 << 62
    for r in sorted(counts.groupBy(F.ceil(step).cast("long").alias("n"))
                    .agg(F.sum(F.octet_length("chunk")).alias("size")).collect(), key=lambda r: -r["n"]):
        held += r["size"]
        if held > limit:
            break
        least = r["n"]
    return least


class Known:
    """The table in a task."""

    def __init__(self, table: pa.Table):
        chunks = table.column("chunk").to_pylist()
        self.ids = dict(zip(chunks, table.column("ids").to_pylist()))
        self.decoded = {c: d for c, d in zip(chunks, table.column("decoded").to_pylist()) if d is not None}
        self.rare: dict[str, tuple[str, str | None]] = {}

    def segment(self, model: Chunks, chunk: str) -> tuple[str, str | None]:
        """A chunk that the table doesn't hold."""
        found = self.rare.get(chunk)
        if found is None:
            if len(self.rare) >= HELD:
                self.rare.clear()
            found = self.rare[chunk] = segmented(model, chunk)
        return found

    def of(self, text: str, model: Chunks) -> tuple[str, str]:
        """(ids, decoded text) of a whole text."""
        chunks = model.of(text)
        ids = list(map(self.ids.get, chunks))
        if self.decoded:
            chunks = [self.decoded.get(c, c) for c in chunks]
        if None in ids:
            for i, known in enumerate(ids):
                if known is None:
                    ids[i], other = self.segment(model, chunks[i])
                    if other is not None:
                        chunks[i] = other
        return ",".join(ids), "".join(chunks)[1:]


def known_chunks(head) -> Known:
    """The process's form of a broadcast (name, table)."""
    cache = worker_cache().__dict__
    name, table = head.value
    if cache.get("known_for") != name:
        cache["known"], cache["known_for"] = Known(table), name
    return cache["known"]


def chunk_table(texts: DataFrame, path: str, head_bytes: int = HEAD_BYTES):
    """The broadcast (name, table) of the most frequent chunks of ``text``."""
    counts = materialize(count_chunks(texts, path), "piece_counts")
    often = counts.filter(F.col("n") >= head_least(counts, head_bytes))
    return texts.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, segment_chunks(often, path).toArrow()))


def encode_documents(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                     head_bytes: int = HEAD_BYTES) -> DataFrame:
    """doc_id, ids (array) and decoded text of every row."""
    path = path or vocabulary_path(MODEL)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    head = chunk_table(rows, path, head_bytes)

    def run(batch: pa.RecordBatch) -> dict:
        found = [known_chunks(head).of(t, chunks_of(path)) for t in texts_of(batch)]
        return {"doc_id": batch.column("doc_id"),
                "ids": pa.array([list(map(int, f[0].split(","))) if f[0] else [] for f in found], pa.list_(pa.int32())),
                "decoded": pa.array([f[1] for f in found], pa.string())}
    return map_batches(rows, run, "doc_id long, ids array<int>, decoded string")


def digest_documents(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                     head_bytes: int = HEAD_BYTES) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row."""
    path = path or vocabulary_path(MODEL)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    head = chunk_table(rows, path, head_bytes)

    def run(batch: pa.RecordBatch) -> dict:
        n, digests = [], []
        for text in texts_of(batch):
            ids, decoded = known_chunks(head).of(text, chunks_of(path))
            n.append(ids.count(",") + 1 if ids else 0)
            digests.append([hashlib.sha256(x.encode()).hexdigest() for x in (ids, decoded)])
        return {"doc_id": batch.column("doc_id"), "n_tokens": pa.array(n, pa.int64()),
                "ids_sha256": pa.array([d[0] for d in digests], pa.string()),
                "decoded_sha256": pa.array([d[1] for d in digests], pa.string())}
    return map_batches(rows, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
