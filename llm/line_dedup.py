"""Operator 4: removal of globally repeated multi-line chunks.

A chunk is two lines that follow each other, blank lines between them passed
over, or one line of at least ``LONG`` words. A rolling hash over the hashes
of the last two lines names the chunk that ends at a line: every line is a
boundary, so that an insertion moves none but its own. (Boundaries where the
rolling hash divides by a number were tried first. They leave the head and the
tail of a passage in chunks with other text: of passages of 2 to 8 lines most
stayed.) Of a chunk that occurs again, anywhere, the first occurrence stays (by
doc_id, then position); the lines of the others go, with the blank ones
between them, once their bytes have been compared. So a passage of two lines
or more, or of one long line, is left once, and the first occurrence of a line
always stays.

Documents are dealt into batches of a few MB. A batch sends each distinct
chunk hash once, so that a chunk in a third of all documents costs one row a
batch; of repeated hashes it sends the text once, which is joined with the
text of the first occurrence on its bytes. Texts are shuffled once: the steps
that read them use one exchange.

Rows: a null text stays null and has no lines; an empty text has one empty
line. A null doc_id comes after all others; rows that repeat a doc_id follow
each other by the hash of their text. All columns of the input are kept, in one
struct, so that their names clash with nothing. A very long text is in one
batch and makes that batch larger. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import _tables as T
from llm import _words as W

line_hash = xxhash.xxh3_128_digest
LONG = 50  # words of a line that is a chunk of its own
BATCH = 4 << 20  # bytes of text in a batch
NO_ID = np.iinfo(np.int64).max


def chunks(lines: list[bytes]) -> list[tuple[int, int]]:
    """(first line, line after the last) of each chunk, in order."""
    full = [i for i, x in enumerate(lines) if x]
    out = []
    for k, i in enumerate(full):
        if len(lines[i]) >= 2 * LONG - 1 and len(lines[i].split()) >= LONG:  # words are runs of bytes other than 0x20 and 0x09-0x0D
            out.append((i, i + 1))
        if k + 1 < len(full):
            out.append((i, full[k + 1] + 1))
    return out


def body(lines: list[bytes], a: int, e: int) -> bytes:
    """The bytes that are compared: the chunk's lines but blank ones."""
    return b"\n".join(filter(None, lines[a:e]))


def _documents(t):
    """(id, hash of the text, row, lines, chunks, hash of each chunk) of a batch's rows, in the order that decides who is first."""
    rows = []
    for k, (i, x) in enumerate(zip(t.column("__id").to_pylist(), t.column("__text").to_pylist())):
        digest = xxhash.xxh3_64_intdigest(x or b"") - (1 << 63)
        lines = x.split(b"\n") if x is not None else []
        cut = chunks(lines)
        of = list(map(line_hash, lines))
        hashes = [of[a] if e == a + 1 else line_hash(of[a] + of[e - 1]) for a, e in cut]
        rows.append((NO_ID if i is None else i, digest, k, lines, cut, hashes))
    return sorted(rows, key=lambda r: r[:3])


def _found(key, t):
    """Batch -> its distinct chunk hashes, their number and the place of the first."""
    first, count = {}, {}
    for r, (i, digest, _, _, _, hashes) in enumerate(_documents(t)):
        for c, h in enumerate(hashes):
            first.setdefault(h, (i, digest, r, c))
            count[h] = count.get(h, 0) + 1
    return pa.table([[key[0].as_py()] * len(first), list(first), *([v[j] for v in first.values()] for j in range(4)), list(count.values())], schema=FOUND)


def _texts(key, docs, repeated):
    """Batch and its repeated hashes -> the text of each, with whether the place is the first of all."""
    wanted = dict(zip(repeated.column("hash").to_pylist(), repeated.column("first").to_pylist()))
    out: dict[bytes, dict] = {}
    for _, _, _, lines, cut, hashes in _documents(docs) if wanted else []:
        for (a, e), h in zip(cut, hashes):
            if h in wanted:  # of texts with one hash, should there be two, the one met first is the source
                of = out.setdefault(h, {})
                of.setdefault(body(lines, a, e), wanted[h] and not of)
    rows = [(key[0].as_py(), h, x, first) for h, of in out.items() for x, first in of.items()]
    return pa.table([list(x) for x in zip(*rows)] or [[]] * 4, schema=TEXTS)


def _kept(schema: pa.Schema):
    """Batch and its confirmed chunks -> the input's rows with what is left of their texts."""
    def run(key, docs, confirmed):
        gone = dict(zip(zip(confirmed.column("hash").to_pylist(), confirmed.column("text").to_pylist()), confirmed.column("first").to_pylist()))
        texts, n_lines, n_removed = [None] * docs.num_rows, [0] * docs.num_rows, [0] * docs.num_rows
        repeated = {h for h, _ in gone}
        stays = {k for k, first in gone.items() if first}  # the first occurrence is in this batch
        for _, _, k, lines, cut, hashes in _documents(docs):
            goes = bytearray(len(lines))
            for (a, e), h in zip(cut, hashes):
                if h not in repeated:
                    continue
                chunk = (h, body(lines, a, e))
                if chunk in stays:
                    stays.discard(chunk)
                elif chunk in gone:
                    goes[a:e] = b"\1" * (e - a)
            left = [x for x, g in zip(lines, goes) if not g]
            n_removed[k] = sum(goes)
            n_lines[k] = len(lines)
            texts[k] = b"\n".join(left) if lines else None
        W.release()
        return pa.Table.from_arrays([docs.column("__row"), *(pa.chunked_array([pa.array(x, f.type)]) for x, f in zip((texts, n_lines, n_removed), list(schema)[1:]))], schema=schema)
    return run


FOUND = pa.schema([("batch", pa.int64()), ("hash", pa.binary()), ("id", pa.int64()), ("digest", pa.int64()), ("row", pa.int64()), ("chunk", pa.int64()), ("n", pa.int64())])
TEXTS = pa.schema([("batch", pa.int64()), ("hash", pa.binary()), ("text", pa.binary()), ("first", pa.bool_())])


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` as (row: struct of all columns but text, text, n_lines, n_removed), one row per row."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = int(total // BATCH) + 1
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    dealt = docs.select(F.struct(*rest).alias("__row"), F.col("doc_id").cast("long").alias("__id"), F.col("text").cast("binary").alias("__text"),
                        F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(count)).alias("__batch")).groupBy("__batch")
    found = dealt.applyInArrow(_found, "batch long, hash binary, id long, digest long, row long, chunk long, n long")
    place = F.struct("id", "digest", "batch", "row", "chunk")
    repeated = (found.groupBy("hash").agg(F.min(place).alias("least"), F.sum("n").alias("n")).filter("n > 1")
                .select(F.col("hash").alias("same"), F.col("least.batch").alias("of")))
    wanted = found.select("batch", "hash").join(repeated, F.col("hash") == F.col("same")).select("batch", "hash", (F.col("batch") == F.col("of")).alias("first"))
    texts = dealt.cogroup(wanted.groupBy("batch")).applyInArrow(_texts, "batch long, hash binary, text binary, first boolean")
    source = texts.filter("first").select(F.col("hash").alias("same"), F.col("text").alias("bytes"))
    confirmed = texts.join(source, (F.col("hash") == F.col("same")) & (F.col("text") == F.col("bytes"))).select("batch", "hash", "text", "first")
    row = dealt._df.schema["__row"]
    out = pa.schema([("row", _arrow(row.dataType)), ("text", pa.binary()), ("n_lines", pa.int64()), ("n_removed", pa.int64())])
    kept = dealt.cogroup(confirmed.groupBy("batch")).applyInArrow(_kept(out), f"row {row.dataType.simpleString()}, text binary, n_lines long, n_removed long")
    return kept.withColumn("text", F.col("text").cast("string"))


def _arrow(kind):
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with what is left of their texts; rows go of which nothing is left but was something."""
    kept = dedup_lines(docs).filter("n_removed = 0 or text <> ''")
    return kept.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    kept = dedup_lines(T.documents(spark, sf_dir))
    return kept.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed", "text")
