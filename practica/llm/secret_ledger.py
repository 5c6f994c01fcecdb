"""Secret scan with an incremental blob ledger.

Every version of every text is content-addressed (SHA-256 of its UTF-8 bytes).
The ledger, a Parquet table in the shared folder, holds the (blob, rule
version) pairs scanned so far; a run scans one row for each pair that is not in
it, appends findings and pairs, and joins findings back to all paths (rows)
that hold the blob. A second run over the same texts scans nothing; a new rule
version scans every blob once more.

The scan reads the texts where they lie: the rows to scan (one for each unseen
blob) are picked by a list of them, or if that is shorter, those that need no scan
(further copies, blobs in the ledger) are removed by a list of those. A first run
over few copies and a later one over few new texts both have a short list. It is
broadcast while it fits in ``common.BROADCAST_BYTES``; texts move only beyond that.

Findings and ledger of a run are written under a run id of their own and count
only once the ledger part is complete, so a run that fails midway is redone.

Defined results: a null text is the empty text. Repeated rows each get the
blob's findings. A null id is kept. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from practica.llm.common import map_batches, replaced, small_side, texts_of, without_rows
from practica.session import materialize

RULE_VERSION = "2"
# Base kinds in their order, then the kinds added here.
KINDS = ("assign", "access", "hex", "key_block", "url_login")
BASE_KINDS = KINDS[:3]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
# Runs below the least length can never hold a longer one, so it is in the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
# The whole key: header, body and END line; without one, to the end of the text.
KEY_BLOCK = re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"
                       r".*?(?:-----END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----|\Z)", re.DOTALL)
URL_LOGIN = re.compile(r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@]+:[^\s/:@]+@")
ASSIGN_HINTS = ("passw", "secret", "token", "api")

FINDINGS = ("blob string, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
LEDGER = "blob string, rule_version string"


def find_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed; code points."""
    spans = []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    if "PRIVATE KEY" in text:
        spans += [(m.start(), m.end(), "key_block") for m in KEY_BLOCK.finditer(text)]
    if "://" in text and "@" in text:
        spans += [(m.start(), m.end(), "url_login") for m in URL_LOGIN.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def written(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def _scan(batch: pa.RecordBatch) -> dict | None:
    out = {k: [] for k in ("blob", "n_assign", "n_access", "n_hex", "base_sha256", "spans")}
    for blob, text in zip(batch.column("blob").to_pylist(), texts_of(batch)):
        spans = find_spans(text)
        if not spans:
            continue
        base = [s for s in spans if s[2] in BASE_KINDS]
        out["blob"].append(blob)
        for kind in BASE_KINDS:
            out[f"n_{kind}"].append(sum(s[2] == kind for s in base))
        out["base_sha256"].append(hashlib.sha256(written(base).encode()).hexdigest())
        out["spans"].append(written(spans))
    return {k: pa.array(v, pa.int64() if k.startswith("n_") else pa.string()) for k, v in out.items()}


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``; empty where nothing has been written yet."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = fs.globStatus(jvm.org.apache.hadoop.fs.Path(path, "run=*/_SUCCESS"))
    if not done:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*sorted(str(s.getPath().getParent()) for s in done))


def rows_to_scan(texts: DataFrame, paths: DataFrame, unseen: DataFrame) -> DataFrame:
    """(blob, text), one row for each unseen blob (equal rows of one id may be
    scanned each), by the shorter list. ``paths`` and ``unseen`` are stored."""
    same = [F.col("a.blob") == F.col("b.blob"), F.col("a.doc_id").eqNullSafe(F.col("b.doc_id"))]
    wanted = unseen.count()
    if wanted <= paths.count() - wanted:
        picked = texts.alias("a").join(small_side(unseen, wanted).alias("b"), same, "left_semi")
    else:
        settled = materialize(paths.alias("a").join(unseen.alias("b"), same, "left_anti").distinct(), "blob_settled")
        picked = without_rows(texts, settled, ["blob", "doc_id"])
    return picked.select("blob", "text")


def scan_new(docs: DataFrame, ledger: str, rule_version: str = RULE_VERSION, id_col: str = "doc_id",
             text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Scan the unseen pairs, extend the ledger at ``ledger`` and return (paths
    with their blob, findings of this rule version by blob)."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.withColumn("blob", F.sha2("text", 256))
    paths = materialize(texts.select("doc_id", "blob"), "blob_paths")
    seen = _stored(spark, f"{ledger}/pairs", LEDGER).filter(F.col("rule_version") == rule_version)
    unseen = materialize(paths.groupBy("blob").agg(F.min("doc_id").alias("doc_id"))
                         .join(seen.select("blob").distinct(), "blob", "left_anti"), "blob_unseen")

    pending = rows_to_scan(texts, paths, unseen)
    run = uuid.uuid4().hex
    found = map_batches(pending, _scan, FINDINGS)
    found.withColumn("rule_version", F.lit(rule_version)).write.parquet(f"{ledger}/findings/run={run}")
    unseen.select("blob", F.lit(rule_version).alias("rule_version")).write.parquet(f"{ledger}/pairs/run={run}")

    findings = _stored(spark, f"{ledger}/findings", FINDINGS + ", rule_version string")
    findings = (findings.filter(F.col("rule_version") == rule_version).drop("rule_version")
                .dropDuplicates(["blob"]))
    return paths, findings


def report(paths: DataFrame, findings: DataFrame) -> DataFrame:
    """Findings joined back to every path; paths without any have zero counts."""
    nothing = hashlib.sha256(b"").hexdigest()
    return (paths.join(findings, "blob", "left")
            .select("doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
                    F.coalesce("base_sha256", F.lit(nothing)).alias("base_sha256"),
                    F.coalesce("spans", F.lit("")).alias("spans"), "blob"))


def redact(text: str, spans: str, mark: str = "[secret]") -> str:
    """``text`` with each of the written spans replaced; overlapping ones as one."""
    out, at = [], 0
    for start, end in (map(int, s.split(":")[1:]) for s in spans.split(",")):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact_documents(docs: DataFrame, ledger: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with found secrets replaced by a mark, all columns and rows;
    ``n_chars`` follows the text. Texts stay in place while the rows with
    findings are few enough to broadcast."""
    _, findings = scan_new(docs, ledger, id_col=id_col, text_col=text_col)
    found = materialize(findings.select(F.col("blob").alias("_blob"), F.col("spans").alias("_spans")), "blob_spans")
    keyed = docs.withColumn("_blob", F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    joined = keyed.join(small_side(found, found.count()), "_blob", "left").select(*docs.columns, "_spans")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = batch.column("_spans").to_pylist()
        batch = batch.drop_columns(["_spans"])
        if not any(spans):
            return batch
        texts = [redact(t, s) if s else t for t, s in zip(batch.column(text_col).to_pylist(), spans)]
        sizes = batch.column("n_chars").to_pylist() if "n_chars" in batch.schema.names else []
        return replaced(batch, {text_col: texts, "n_chars": [len(t) if s else n
                                                             for t, s, n in zip(texts, spans, sizes)]})
    return map_batches(joined, run, docs.schema)
