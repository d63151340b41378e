"""Operators 11 to 13: against the tokenizer library, exact arithmetic and plain restatements."""

import hashlib
import math
import random
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from llm import fill_middle as M
from llm import queries as Q
from llm import token_counts as C
from llm import tokens
from llm import whitening as H
from tests.llm.conftest import SF

# --- 11: token counts ---------------------------------------------------------------


@pytest.fixture(scope="module")
def counter():
    return C.Counter(C.FILE)


@pytest.fixture(scope="module")
def tokenizer():
    return tokens.Tokenizer.from_file(C.FILE)


def _texts(seed: int) -> list[str]:
    rng = random.Random(seed)
    out = ["", "a", "aaaaaaaaaaaaaaa" * 20, "<|endoftext|> x <|endoftext|><|endoftext|>", "<|endoftext|", "漢字 é😀 ½ ² ①\x1c\x85 z", "don't we'll I'D", "  \n\n   x\t"]
    out += ["=" * 5001, "a" * 3333, "ab" * 4000, "!!!!!!!!!!!---------=====" * 30]
    out += ["".join(rng.choice("abcdeéx -!=1 \n ") for _ in range(rng.randrange(300))) for _ in range(300)]
    return out + ["".join(rng.choice("aab") for _ in range(n)) for n in (511, 512, 513, 700, 9000)]


def _library(tokenizer, texts):
    return [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def test_counts_equal_the_library(counter, tokenizer):
    texts = _texts(1)
    assert counter.count(texts) == _library(tokenizer, texts)


def test_both_ways_of_merging_are_one(monkeypatch, tokenizer):
    monkeypatch.setattr(C, "LONG", 4)  # nearly all pre-tokens go the way of long ones
    texts = _texts(2)
    assert C.Counter(C.FILE).count(texts) == _library(tokenizer, texts)


def test_memory_starts_anew(monkeypatch, tokenizer):
    monkeypatch.setattr(C, "KEPT", 20)
    c, texts = C.Counter(C.FILE), _texts(3)
    assert [c.count([t])[0] for t in texts] == _library(tokenizer, texts) and len(c.known) < 200


def test_ranks_of_all_pairs(counter):
    pairs = np.random.default_rng(0).integers(0, counter.table.size, (5000, 2)).astype(np.int32)
    model = {tuple(p): k for k, p in enumerate(_pairs())}
    some = np.array(list(model)[::7], np.int32)
    for found in (some, pairs):
        want = [model.get((int(a), int(b)), C.NO_RANK) for a, b in found]
        assert counter.table.rank(found[:, 0], found[:, 1]).tolist() == want


def _pairs():
    import json
    with open(C.FILE, encoding="utf-8") as f:
        model = json.load(f)["model"]
    return [(model["vocab"][a], model["vocab"][b]) for a, b in (m.split(" ") if isinstance(m, str) else m for m in model["merges"])]


def test_a_file_whose_ranks_are_out_of_order_is_refused(tmp_path):
    import json
    with open(C.FILE, encoding="utf-8") as f:
        data = json.load(f)
    data["model"]["merges"] = data["model"]["merges"][::-1]
    bad = tmp_path / "bad.json"
    bad.write_text(json.dumps(data))
    with pytest.raises(ValueError, match="ranks before"):
        C.Merges(str(bad))


def test_counts_of_documents(spark, rows, tokenizer):
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in C.op11_rank_synchronous_counts(spark, SF).collect()}
    want = dict(zip((i for i, _ in rows), zip((len(t.encode()) for _, t in rows), _library(tokenizer, [t for _, t in rows]))))
    assert got == {i: (b, n, n > 512) for i, (b, n) in want.items()}


def test_counts_of_awkward_rows(awkward, tokenizer):
    key = lambda x: (str(x[0]), x[1:])
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in C.count_tokens(awkward).collect()), key=key)
    texts = [(r.doc_id, r.text or "") for r in awkward.collect()]
    want = [(i, len(t.encode()), n, n > 512) for (i, t), n in zip(texts, _library(tokenizer, [t for _, t in texts]))]
    assert got == sorted(want, key=key)
    assert C.count_tokens(awkward.limit(0)).count() == 0


# --- 12: whitening -------------------------------------------------------------------


def _exact(vectors):
    """Of lists of entries: deviations, covariance (rounded from exact fractions), centred integers over n."""
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors], object)
    n = len(x)
    y = n * x - x.sum(0)
    cov = np.array([[float(Fraction(int(a), n**3)) for a in r] for r in y.T.dot(y)])
    return [int(s) for s in (y**2).sum(1)], cov, np.array([[float(Fraction(int(a), n)) for a in r] for r in y])


def _check_whitening(got, ids, vectors, components=8):
    deviations, cov, centred = _exact(vectors)
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    k = min(components, len(cov))
    want = centred @ v[:, :k] / np.sqrt(e[:k])
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    found = np.array([[by[i][c + 1].whitened for c in range(k)] for i in ids])
    assert np.abs(found - want * np.sign((found * want).sum(0))).max() < 1e-9
    assert [by[i][1].deviation_exact for i in ids] == deviations
    assert all((r.deviation == r.deviation_exact) if r.deviation_exact < 2**63 else r.deviation is None for r in got)
    assert all(abs(r.explained - e[r.component - 1] / np.trace(cov)) < 1e-9 and r.n == len(ids) and r.identity_error < 1e-9 for r in got)
    assert len(got) == len(ids) * k


def test_whitening_of_embeddings(spark):
    e = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    ids = sorted(e)
    _check_whitening(H.op12_polarised_whitening(spark, SF).collect(), ids, [e[i] for i in ids])


@pytest.mark.parametrize("scale", [1.0, 1e4, 1e9])
def test_whitening_of_wide_values(spark, scale):
    """More limbs, and integers beyond a long."""
    rng = np.random.default_rng(5)
    vectors = (rng.standard_normal((300, 5)) @ rng.standard_normal((5, 5)) * scale + scale).tolist()
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>").repartition(7)
    _check_whitening(H.whiten(df).collect(), list(range(300)), vectors)


def test_integers_beyond_a_long():
    c = H.Centre(1 << 30, [5 << 50, -(3 << 50)], [-(1 << 50), -(1 << 50)], [1 << 50, 1 << 50])
    assert c.wide and c.of(np.array([[1 << 50, -(1 << 50)]])).tolist() == [[(1 << 80) - (5 << 50), -(1 << 80) + (3 << 50)]]
    z = np.array([-(1 << 81) - 12345, 1 << 70, -1, 0], object)
    parts = H.split(z, H.limbs(1 << 82))
    assert [sum(int(p[i]) << (H.LIMB * k) for k, p in enumerate(parts)) for i in range(4)] == z.tolist()


def test_whitening_of_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [[1.0, 2.0, 3.5], [0.5, -2.0, 1.0], [2.0, 2.0, -1.0], [2.0, 2.0, -1.0], [0.0, 0.0, 0.0]]
    rows = [(1, good[0], 1), (2, good[1], 1), (3, good[2], 1), (3, good[3], 1), (None, good[4], 1), (6, None, 1), (7, [], 1), (8, [nan, 1.0, 2.0], 1),
            (9, [1.0, inf, 2.0], 1), (10, [1.0, None, 2.0], 1), (11, [1.0, 2.0], 1), (12, [1e300, 0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component int").repartition(5)
    got = H.whiten(df).collect()
    assert sorted(str(r.vec_id) for r in got) == sorted(["1"] * 3 + ["2"] * 3 + ["3"] * 6 + ["None"] * 3)
    deviations, _, _ = _exact(good)
    assert sorted({(str(r.vec_id), r.deviation) for r in got}) == sorted({(str(i), d) for (i, _, _), d in zip(rows, deviations)})
    assert H.whiten(df.limit(0)).count() == 0 and H.whiten(df.filter("vec_id between 6 and 10")).count() == 0
    alone = H.whiten(df.filter("vec_id = 1")).collect()
    assert [(r.component, r.deviation, r.whitened, r.explained) for r in sorted(alone, key=lambda r: r.component)] == [(k, 0, None, None) for k in (1, 2, 3)]
    flat = H.whiten(spark.createDataFrame([(k, [float(k % 3), 1.0]) for k in range(9)], "vec_id long, embedding array<double>")).collect()
    assert all((r.whitened is None) == (r.component == 2) and r.identity_error < 1e-9 for r in flat)


# --- 13: fill-in-middle --------------------------------------------------------------


def _transformed(doc_id, text):
    """A plain restatement: n, form, prefix, middle, output."""
    t = text or ""
    d = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(t) + 1), h[1] % (len(t) + 1)))
    p, m, s = t[:a], t[a:b], t[b:]
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(t), "plain", None, None, t
    return len(t), *(("spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else ("psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"))


def _mixed(seed: int) -> list[str]:
    rng = np.random.default_rng(seed)
    return ["", "a", "é漢😀x\ny", "\n\n", "abc\ndef", "x\n", "😀" * 100, "\U0010ffffࠀ߿\x7f"] + ["".join(rng.choice(list("aé漢😀 \n1.z"), int(rng.integers(0, 200)))) for _ in range(200)]


def test_ranks_of_the_wavelet_matrix():
    symbols = np.random.default_rng(0).integers(0, 8, 3000).astype(np.uint8)
    at = np.append(np.random.default_rng(1).integers(0, 3001, 300), [0, 3000, 64, 63, 65])
    for s in (symbols, symbols[:64], symbols[:0], np.full(200, 3, np.uint8)):
        m = M.WaveletMatrix(s)
        for c in range(8):
            places = np.minimum(at, len(s))
            assert m.rank(c, places).tolist() == [int((s[:a] == c).sum()) for a in places]


@pytest.mark.parametrize("unit", ["char", "line"])
def test_cuts(unit):
    import re
    texts = _mixed(2)
    data = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in data])])
    b = M.Boundaries(np.frombuffer(b"".join(data), np.uint8), offsets, unit)
    units = [list(t) if unit == "char" else re.findall(r"[^\n]*\n|[^\n]+", t) for t in texts]
    assert b.units.tolist() == [len(u) for u in units]
    for part in (0, 0.2, 0.5, 0.9, 1):
        k = (b.units * part).astype(np.int64)
        assert (b.cut(k) - offsets[:-1]).tolist() == [len("".join(u[:j]).encode()) for u, j in zip(units, k)]


def test_fill_middle_equals_the_plain_form(spark):
    texts = [*_mixed(3), "with <P> inside", "<M>", None, "x" * 70_000 + "😀\n" * 30_000]
    data = [(None if k % 50 == 49 else k, t) for k, t in enumerate(texts)]
    made = M.transform(spark.createDataFrame(data, "doc_id long, text string")).withColumn("back", M.restored(M.F.col("output"), M.F.col("form")))
    got = {(r.doc_id, r.back): (r.n, r.form, r.prefix_units, r.middle_units, r.output) for r in made.collect()}
    assert got == {(i, t or ""): _transformed(i, t) for i, t in data}
    assert {r[1] for r in got.values()} == {"plain", "psm", "spm"}


def test_fill_middle_by_lines(spark):
    df = spark.createDataFrame([(k, "one\ntwo\n\nfour" + "\n" * (k % 2)) for k in range(60)], "doc_id long, text string")
    made = M.transform(df, unit="line").withColumn("back", M.restored(M.F.col("output"), M.F.col("form"))).collect()
    assert {(r.n, r.back) for r in made} == {(4, "one\ntwo\n\nfour"), (4, "one\ntwo\n\nfour\n")}
    for r in made:
        if r.form == "psm":
            prefix, rest = r.output[3:].split("<S>")
            assert (prefix == "" or prefix.endswith("\n") or prefix == r.back) and (rest.split("<M>")[0] in r.back)


def test_fill_middle_of_awkward_rows(awkward):
    got = [(r.doc_id, r.n, r.form, r.prefix_units, r.middle_units, r.output) for r in M.transform(awkward).collect()]
    assert sorted(map(repr, got)) == sorted(repr((r.doc_id, *_transformed(r.doc_id, r.text))) for r in awkward.collect())
    assert M.transform(awkward.limit(0)).count() == 0


def test_fill_middle_matches_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(Q.ORACLES["op13_wavelet_fill_middle"])
    got = M.op13_wavelet_fill_middle(spark, SF)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
    assert all(r.restored_sha256 == hashlib.sha256(t.encode()).hexdigest() for r, t in zip(got.orderBy("doc_id").collect(), (t for _, t in _rows(spark))))


def _rows(spark):
    return sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
