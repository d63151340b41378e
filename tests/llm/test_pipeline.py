"""The pipeline against plain restatements of its stages, and what the entry point registers."""

import corpus_pipeline as C
from llm import _tables as T
from llm import language_id as G
from tests.llm import brute
from tests.llm.conftest import SF
from tests.llm.test_text import _check_packing


def test_stages(spark, docs, rows):
    assert [n for n, _ in C.STAGES] == ["language_id", "line_dedup", "near_duplicates", "decontamination", "packing"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    frame, now = docs, dict(rows)
    for name, stage in C.STAGES[:-1]:
        frame = T.store(stage(spark, frame, SF), "stage")
        assert frame.columns == docs.columns
        got = {r.doc_id: r.text for r in frame.collect()}
        if name == "language_id":
            pred = {r.doc_id: r for r in G.identify(docs).collect()}
            want = {i: t for i, t in now.items() if pred[i].lang_pred != "und" and pred[i].score >= 0.5}
            assert len(want) > 0.95 * len(now)
        elif name == "line_dedup":
            want = {i: t for i, t in brute.without_repeated_lines(list(now.items())).items() if t or not now[i]}
            assert all(r.n_chars == len(r.text) for r in frame.collect())
        elif name == "near_duplicates":
            want = {i: now[i] for i, (_, c) in brute.components(list(now.items())).items() if c == i}
        else:
            hit = {i for i, _ in brute.contamination(list(now.items()), items)}
            want = {i: t for i, t in now.items() if i not in hit}
            assert hit
        assert got == want, name
        now = got
    _check_packing(C.STAGES[-1][1](spark, frame, SF).collect(), list(now.items()))


def test_run(spark):
    pieces = C.run(spark, SF)
    assert pieces.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert pieces.count() > 0


def test_awkward_rows_pass_the_stages(spark, awkward):
    frame = awkward
    for name, stage in C.STAGES:
        frame = T.store(stage(spark, frame, SF), "stage")
        if name != "packing":
            assert frame.columns == awkward.columns
    assert frame.count() > 0
    empty = awkward.limit(0)
    for _, stage in C.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0


def test_registered():
    import __spark_entry__ as E
    names = [n for n in E.queries() if n.startswith("op") and n[2:3].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in E.queries()


def test_line_dedup_matches_sql(spark):
    from tests.oracle_harness import compare, duck_conn
    r = compare(spark, "op4_line_dedup", SF, duck_conn(SF), verbose=True)
    assert r["cols_match"] and r["rows_match"] and r["hash_match"], r
