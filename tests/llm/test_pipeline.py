"""The stages of the pipeline, each against brute force on its own input, and the whole run."""

import duckdb
import pytest

from . import cases

DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    import corpus_pipeline as C
    from weftline.llm.shared import materialize

    docs = materialize(cases.frame(spark, extra=[(None, "w " * 30)]).select(*C.COLUMNS))
    texts = lambda df: {r.doc_id: r.text for r in df.collect() if r.doc_id is not None}
    names = [n for n, _ in C.STAGES]
    assert names == ["quality rules", "line dedup", "n-gram Jaccard join", "suffix-array dedup", "packing"]
    for name, stage in C.STAGES:
        before, out = texts(docs), materialize(stage(spark, docs, DIR))
        if name == "packing":
            assert {r.doc_id for r in out.collect() if r.doc_id is not None} == set(before)
            break
        assert out.columns == C.COLUMNS
        after = texts(out)
        if name == "quality rules":
            assert after == {k: before[k] for k, v in cases.quality(before).items() if not v[5]}
        elif name == "line dedup":
            assert after == {k: v[2] for k, v in cases.lines(before).items()}
        elif name == "n-gram Jaccard join":
            assert after == {k: before[k] for k, v in cases.linked(before).items() if v[1] == k}
        else:
            assert after == cases.whole_characters(before)
        docs = out


def test_suffix_stage_keeps_replacement_characters(spark):
    """U+FFFD of the input stays in a document that loses a passage; a halved character goes whole at both edges."""
    import corpus_pipeline as C

    passage = "".join(chr(0x4E00 + 7 * k) for k in range(40))
    # Beside the passage: U+00E9, U+03A9 and U+0129 have their last byte in common, U+4E00 to U+4E02 their first two, so all cuts fall inside them.
    docs = {1: "first \ufffd text \u00e9" + passage + "\u4e00 end", 2: "other \ufffd\ufffd words \u03a9" + passage + "\u4e01\ufffd tail \ufffd"}
    docs[3] = "odd \u0129" + passage + "\u4e02 \ufffd"
    x = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in docs.items()], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in C.substring_dedup(spark, x, DIR).collect()}
    assert got[1] == (docs[1], len(docs[1]))
    assert got[2][0] == "other \ufffd\ufffd words \ufffd tail \ufffd" and got[2][1] == len(got[2][0])
    assert got[3][0] == "odd  \ufffd" and got[3][1] == len(got[3][0])


def test_run_and_empty(spark):
    import corpus_pipeline as C

    assert C.run(spark, DIR).count() > 0
    docs = spark.read.parquet(f"{DIR}/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        assert stage(spark, docs, DIR).count() == 0


def test_workers_get_small_batches(spark):
    """However long documents are, few megabytes of them are in a worker at once."""
    import corpus_pipeline as C
    from pyspark.sql import functions as F

    def sizes(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    for _, stage in C.STAGES[2:]:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        stage(spark, docs, DIR)
        long = spark.range(0, 4000, 1, 1).select("id", F.repeat(F.lit("x"), 2000).alias("text"))
        assert max(r.n for r in long.mapInArrow(sizes, "n long").collect()) < C.BATCH_BYTES + 100_000
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")


def test_memory_goes_back_when_variables_are_gone(monkeypatch):
    """A task's last batch and what was made of it are not held while free memory is handed back."""
    import weakref

    from weftline.llm import bytewise

    class Batch:
        pass

    made, held = [], []

    def run(batches):
        for b in batches:
            last = Batch()
            yield b
        made.append(weakref.ref(last))

    monkeypatch.setattr(bytewise, "give_back", lambda: held.append(made[0]() is not None))
    assert list(bytewise.giving_back(run)([1, 2])) == [1, 2] and held == [False]


@pytest.mark.parametrize("name", ["op1_host_rules", "op7_host_reputation", "op10_line_dedup", "op11_drake_bounds", "op12_partial_distance"])
def test_queries_with_sql(spark, name):
    from weftline.llm import queries as q

    c = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings"):
        c.sql(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    df = q.queries()[name](spark, DIR)
    cols = sorted(df.columns)
    r = c.sql(q.oracle_sql()[name])
    at = [r.columns.index(x) for x in cols]
    assert sorted((tuple(x[k] for k in cols) for x in df.collect()), key=repr) == sorted((tuple(x[i] for i in at) for x in r.fetchall()), key=repr)


def test_every_query_runs(spark):
    from weftline.llm import queries as q

    assert {n.split("_")[0] for n in q.queries()} == {f"op{k}" for k in range(1, 14)}
    for name in ("op2_lattice", "op3_partenum", "op4_pair_index", "op5_jump_hash", "op6_spotsigs", "op8_bucket_pointers"):
        assert q.queries()[name](spark, DIR).count() == 200
    packed = q.queries()["op13_certified_repacking"](spark, DIR).collect()
    assert len({r.doc_id for r in packed}) == 200 and all(r.offset + r.length <= 2048 for r in packed)
