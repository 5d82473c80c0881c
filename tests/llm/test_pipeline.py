"""The corpus pipeline stage by stage against plain versions of its decisions."""
import corpus_pipeline
import pyarrow as pa
from cargolens.llm import decontam, entry, secret_scan
from cargolens.llm.common import BATCH_BYTES, BATCH_SETTING
from test_near_dup import brute as same_class
from test_packing import check as packing_of

DATA = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select(*COLUMNS).cache()
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_dup", "decontam", "secrets", "packing"]

    def after(name, docs):
        out = stages[name](spark, docs, DATA).cache()
        assert out.columns == COLUMNS
        assert out.dtypes == docs.dtypes
        return out, {r["doc_id"]: r["text"] for r in out.collect()}

    good, kept = after("quality", docs)
    judged = entry.op1_quality_rules(spark, DATA).collect()
    assert set(kept) == {r["doc_id"] for r in judged if r["kept"]}
    assert kept.items() <= before.items()

    single, kept = after("near_dup", good)
    classes = same_class([(r["doc_id"], r["text"]) for r in good.collect()])
    assert set(kept) == set(classes.values())

    items = [decontam.shingles(decontam.words_of(r["text"])) for r in
             spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    clean, left = after("decontam", single)
    leaked = {k for k, t in kept.items() if any(
        decontam.share(i, decontam.shingles(decontam.words_of(t))) >= decontam.COVERAGE
        for i in items if i)}
    assert set(left) == set(kept) - leaked

    hidden, redacted = after("secrets", clean)
    assert set(redacted) == set(left)
    for k, text in redacted.items():
        spans = secret_scan.find(left[k])
        assert (text == left[k]) == (not spans)
        assert not any(left[k][start:end] in text for start, _, end in spans)
    assert {r["n_chars"] == len(r["text"]) for r in hidden.collect()} == {True}

    packed = stages["packing"](spark, hidden, DATA).collect()
    assert packing_of(redacted, packed) < 0.05


def test_run(spark):
    pieces = corpus_pipeline.run(spark, DATA)
    assert pieces.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens",
                              "sequence_id", "offset"]
    assert pieces.count() > 0


def test_odd_documents(spark, tmp_path):
    """Null and empty texts, repeated rows, extra columns, and a table without rows."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars int, __key string, kept int"
    long = "some fairly ordinary words that make a text of more than ten words in all"
    rows = [(1, None, None, None, None, "x", 1), (2, "", "en", "s", 0, "x", 1), (3, long, "en", "s", 70, "x", 1),
            (3, long, "en", "s", 70, "x", 1), (4, long, None, None, None, None, None),
            (None, "another text of more than ten words that nobody else has here at all", "en", "s", 1, "x", 1)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, DATA)
            assert docs.columns == [c.strip().split()[0] for c in schema.split(",")], name
        ids = sorted(r["doc_id"] or 0 for r in docs.collect())
        assert ids == ([0, 3] if data else [])
        assert corpus_pipeline.STAGES[-1][1](spark, docs, DATA).count() == len(ids)


def test_batches_are_bounded(spark):
    """Each stage alone sees to it that workers get texts in small Arrow batches, and every row of them."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64()), pa.array([batch.nbytes], pa.int64())],
                                             ["n", "size"])

    set_before = spark.conf.get(BATCH_SETTING, None)
    none = spark.read.parquet(f"{DATA}/documents.parquet").select(*COLUMNS).where("false")
    texts = spark.range(0, 2001, 1, 1).selectExpr("repeat('x', if(id = 1000, 6000000, 10000)) as text")
    for _, stage in corpus_pipeline.STAGES:
        spark.conf.unset(BATCH_SETTING)
        stage(spark, none, DATA)
        found = texts.mapInArrow(sizes, "n long, size long").collect()
        assert sum(r["n"] for r in found) == 2001
        assert sorted(r["size"] for r in found)[-2] <= 1.05 * BATCH_BYTES  # the last holds the long text
    try:
        spark.conf.set(BATCH_SETTING, "12345")
        corpus_pipeline.hide_secrets(spark, none, DATA)
        assert spark.conf.get(BATCH_SETTING) == "12345"
    finally:
        spark.conf.unset(BATCH_SETTING)
        if set_before is not None:
            spark.conf.set(BATCH_SETTING, set_before)
