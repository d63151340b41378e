"""Operator 6: language of each text, word first and backing off to character n-grams.

A known word scores its log frequency in each language. An unseen word scores
the mean log frequency of its character n-grams (with its bounds) of the
greatest length, from ``LONGEST`` down to 1, of which the model knows one. A
text's score is the posterior of its best language, all alike beforehand.

The model learns from a bounded sample: about ``SAMPLE`` labelled rows, taken
by a hash of doc_id, and keeps the ``WORDS`` and ``GRAMS`` most frequent ones
per language (and length). Everything is then scored in one narrow pass.

Rows: null texts and texts without a letter are ``und`` with score 0; so is
everything if no row is labelled. Ties go to the first language by name. A
null doc_id is neither held out nor learned from; repeated rows count each. Very
long texts are a batch of their own. An empty table gives no rows. Other columns
are kept by ``accepted`` and not looked at by ``identify``.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm import _tables as T
from llm import _words as W
from llm import tokens

SAMPLE = 12_000  # labelled rows learned from
WORDS, GRAMS = 30_000, 8_000
LONGEST = 5
CACHED = 300_000  # unseen words whose scores a task remembers
UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")
_RANGE = float(1 << 64)


def words(text: str) -> list[str]:
    """Runs of letters (category L), lower-cased."""
    found = LETTERS.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    return [w for x in found for w in "".join(c if c.isalpha() else " " for c in x).split()]  # number signs such as ½ are no letters


def grams(word: str, n: int) -> list[str]:
    w = f"<{word}>" if n > 1 else word
    return [w[i : i + n] for i in range(len(w) - n + 1)]


def _counts(batches):
    tokens.forget()  # if this worker has packed before
    for b in W.slices(batches, "text"):
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
            found, n = np.unique(np.array(words(text) or [""], object).astype(str), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found)), pa.array(found.tolist()), pa.array(n, pa.int64())], ["lang", "word", "n"])


def _grams_of(batches):
    for batch in batches:
        for i in range(0, batch.num_rows, 2000):
            b = batch.slice(i, 2000)
            out: dict = {}
            for lang, word, n in zip(*(b.column(c).to_pylist() for c in ("lang", "word", "n"))):
                for k in range(1, LONGEST + 1):
                    for g in grams(word, k):
                        out[lang, k, g] = out.get((lang, k, g), 0) + n
            columns = [pa.array([x[j] for x in out], t) for j, t in enumerate((pa.string(), pa.int32(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(out.values()), pa.int64())], ["lang", "k", "gram", "n"])
    W.release()


def learn(labelled: DataFrame) -> dict:
    """Model from ``labelled(doc_id, text, lang)``, no nulls: languages, log frequencies of words and of grams by length."""
    rows = labelled.count()
    share = int(min(1.0, SAMPLE / max(rows, 1)) * _RANGE) - (1 << 63)
    sample = labelled.filter(F.xxhash64("doc_id") <= F.lit(min(share, (1 << 63) - 1)))
    seen = T.store(sample.select("lang", "text").mapInArrow(_counts, "lang string, word string, n long").filter("word <> ''").groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    top = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    known = seen.withColumn("k", F.lit(0)).select("lang", "k", F.col("word").alias("x"), "n", F.row_number().over(top).alias("r")).filter((F.col("r") <= WORDS) & (F.col("n") > 1))
    by = Window.partitionBy("lang", "k").orderBy(F.desc("n"), "gram")
    parts = seen.mapInArrow(_grams_of, "lang string, k int, gram string, n long").groupBy("lang", "k", "gram").agg(F.sum("n").alias("n"))
    parts = parts.select("lang", "k", F.col("gram").alias("x"), "n", F.row_number().over(by).alias("r")).filter(F.col("r") <= GRAMS)
    found = known.unionByName(parts).toPandas()  # bounded by WORDS, GRAMS and the number of languages
    T.drop(seen)
    langs = sorted(found["lang"].unique())
    model = {"langs": langs, "tables": []}
    for k in range(LONGEST + 1):
        t = found[found["k"] == k]
        index = {x: i for i, x in enumerate(sorted(t["x"].unique()))}
        c = np.zeros((len(index), len(langs)))
        if len(t):
            c[t["x"].map(index), t["lang"].map({x: i for i, x in enumerate(langs)})] = t["n"]
        logs = np.log((c + 0.1) / (c.sum(0) + 0.1 * (len(index) + 1)))
        model["tables"].append({x: logs[i] for x, i in index.items()})
    return model


class _Scores(dict):
    """Word -> row of ``matrix`` with its log frequencies by language."""

    def __init__(self, model: dict):
        super().__init__()
        known, self.grams = model["tables"][0], model["tables"]
        self.known, self.width = known, len(model["langs"])
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.matrix = np.zeros((len(self.known) + CACHED, self.width))
        for i, (w, v) in enumerate(self.known.items()):
            self[w] = i
            self.matrix[i] = v

    def __missing__(self, word: str) -> int:
        v = np.zeros(self.width)
        for k in range(LONGEST, 0, -1):
            found = [self.grams[k][g] for g in grams(word, k) if g in self.grams[k]]
            if found:
                v = np.mean(found, axis=0)
                break
        i = len(self)
        self[word] = i
        self.matrix[i] = v
        return i

    def full(self) -> bool:
        return len(self) >= len(self.matrix) - (CACHED >> 2)


def _predict(texts: list[str | None], scores: _Scores, langs: list[str]):
    out = []
    for t in texts:
        found = words(t) if t else []
        if not found or not langs:
            out.append((UNKNOWN, 0.0))
            continue
        total = np.zeros(len(langs))
        for i in range(0, len(found), CACHED >> 2):  # as many new words fit in
            if scores.full():
                scores.reset()
            total += scores.matrix[list(map(scores.__getitem__, found[i : i + (CACHED >> 2)]))].sum(0)
        p = np.exp(total - total.max())
        p /= p.sum()
        best = int(np.argmax(p))
        out.append((langs[best], float(p[best])))
    return out


def predictions(model: dict):
    """Function for mapInArrow: (doc_id, held_out, text) -> (doc_id, held_out, lang_pred, score)."""
    def run(batches):
        tokens.forget()
        scores = _Scores(model)
        for b in W.slices(batches, "text"):
            got = _predict(b.column("text").to_pylist(), scores, model["langs"])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array([x for x, _ in got], pa.string()), pa.array([x for _, x in got], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])
    return run


def held_out(parts: int, part: int):
    """Whether crc32(doc_id as text) mod ``parts`` is ``part``."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == part, F.lit(False))


def labelled(docs: DataFrame) -> DataFrame:
    return docs.filter(~held_out(4, 2) & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")


def identify(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text, lang)``: doc_id, held_out, lang_pred, score."""
    model = learn(labelled(docs))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(4, 2).alias("held_out"), "text")
    return rows.mapInArrow(predictions(model), "doc_id long, held_out boolean, lang_pred string, score double")


def accepted(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language is known with a score of ``least``."""
    model = learn(labelled(docs))

    def run(batches):
        tokens.forget()
        scores = _Scores(model)
        for b in W.slices(batches, "text"):
            got = _predict(b.column(b.schema.get_field_index("text")).to_pylist(), scores, model["langs"])
            yield b.filter(pa.array([x != UNKNOWN and p >= least for x, p in got], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    return identify(T.documents(spark, sf_dir))
