"""Changed features are written by as many tasks as they have partitions."""

import __spark_entry__  # noqa: F401  (registers the plans in their order)
from gridloom.plans import q_io


def test_changed_features_keep_their_partitions(spark, sf_dir, monkeypatch):
    real_boxes, real_start, seen = q_io._label_boxes, q_io.start_reseed, {}

    def start(spark, source, schema, *rest, files_per_batch):
        seen["files"] = len(spark.read.schema(schema).parquet(source).inputFiles())
        seen["per_batch"] = files_per_batch
        return real_start(spark, source, schema, *rest, files_per_batch=files_per_batch)

    want = sorted(map(tuple, q_io.q_stream_reseed(spark, sf_dir).collect()))
    monkeypatch.setattr(q_io, "_label_boxes", lambda t: real_boxes(t).repartition(4))
    monkeypatch.setattr(q_io, "start_reseed", start)
    got = sorted(map(tuple, q_io.q_stream_reseed(spark, sf_dir).collect()))
    assert got == want and got
    assert seen["files"] > 2 and seen["files"] <= 2 * seen["per_batch"]
