"""The pipeline's Python workers get a few MB of rows at a time, and every row."""

import pyarrow as pa
import pytest
from helpers import DOCS, row

from weftline.llm import minhash, pieces, quality
from weftline.session import BATCH_BYTES

ROWS = 5000


@pytest.fixture
def wide(spark, tmp_path):
    """One partition of 20 MB of texts, which is one batch by default."""
    path = str(tmp_path / "docs")
    spark.createDataFrame([row(i, f"{i} " * 800) for i in range(ROWS)], DOCS).coalesce(1).write.parquet(path)
    spark.createDataFrame([(i, 1) for i in range(ROWS)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    yield spark.read.parquet(path).coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", before)


def is_bounded(sizes, rows):
    return rows == ROWS and len(sizes) > 3 and max(sizes) < 1.5 * BATCH_BYTES


def test_encoding_gets_bounded_batches(spark, wide, tmp_path, monkeypatch):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")

    def sizes(batches, model, check):
        for batch in batches:
            columns = [pa.array([[batch.nbytes]] * batch.num_rows, pa.list_(pa.int32())), pa.array([True] * batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*batch.schema.names[:-1], "ids", "restored"])

    monkeypatch.setattr(pieces, "encode_batches", sizes)
    found = [r["ids"][0] for r in corpus_pipeline.to_ids(spark, wide, str(tmp_path)).select("ids").collect()]
    assert is_bounded(set(found), len(found))


def test_quality_gets_bounded_batches(spark, wide, tmp_path, monkeypatch):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")

    def sizes(batches, model, threshold):
        for batch in batches:
            doc = batch.column(0)
            at = doc.type.get_field_index("source")
            marked = [pa.array([str(batch.nbytes)] * batch.num_rows) if i == at else doc.field(i) for i in range(doc.type.num_fields)]
            columns = [pa.StructArray.from_arrays(marked, names=[f.name for f in doc.type]), *batch.columns[1:-1],
                       pa.array([1.0] * batch.num_rows), pa.array([1] * batch.num_rows, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "score", "predicted"])

    monkeypatch.setattr(quality, "fit", lambda docs, labels: object)
    monkeypatch.setattr(quality, "score_batches", sizes)
    found = [int(r["source"]) for r in corpus_pipeline.good_quality(spark, wide, str(tmp_path)).select("source").collect()]
    # A row is there with its text twice: in itself and to be scored.
    assert is_bounded(set(found), len(found))


def test_near_dedup_gets_bounded_batches(spark, wide, tmp_path, monkeypatch):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    seen = []

    def near_duplicates(docs):
        found = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])
                                                 for b in batches), "n long, size long").collect()
        seen.extend((r["n"], r["size"]) for r in found)
        return spark.range(ROWS).selectExpr("id as doc_id", "true as kept", "id as component_id")

    monkeypatch.setattr(minhash, "near_duplicates", near_duplicates)
    assert corpus_pipeline.one_of_each(spark, wide, str(tmp_path)).count() == ROWS
    assert is_bounded([size for _, size in seen], sum(n for n, _ in seen))
