import public_tokenizers
import pyarrow as pa
from frames import docs

from strata.llm import byte_bpe as B
from strata.llm import toxicity as X


def held(spark, count):
    """``count()`` in the Python workers that are kept for later tasks."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([count()] * batch.num_rows, pa.int64())], ["n"])
    return max(r.n for r in spark.range(0, 64, 1, 8).mapInArrow(run, "n long").collect())


def frame(spark):
    return docs(spark, [(d, " ".join(f"word{d}x{k}" for k in range(30)), "en", "s") for d in range(80)]).repartition(8)


def test_idle_workers_hold_no_pieces(spark):
    path = public_tokenizers.path(B.RANKS)
    assert B.encode(frame(spark)).where("length(token_ids) > 0").count() == 80

    def count():
        return sum(len(c._memory) + len(c._fits) for key, c in B._CODERS.items() if key[0] == path)
    assert held(spark, count) == 0


def test_scored_rows_leave_in_parts():
    """A batch of whole texts is not held a second time, with its scores."""
    batch = pa.RecordBatch.from_arrays([pa.array(range(2500)), pa.array(f"text {k}" for k in range(2500))], ["doc_id", "text"])
    out = list(X.parts(batch))
    assert [p.num_rows for p in out] == [1000, 1000, 500] and not list(X.parts(batch.slice(0, 0)))
    assert [v for p in out for v in p.column(0).to_pylist()] == list(range(2500))
    assert out[1].column(1).buffers()[2].address == batch.column(1).buffers()[2].address
