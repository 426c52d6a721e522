"""The streaming validator counts files as they land, once each."""

import os
import tempfile

from pyspark.sql import functions as F

from quarry.streaming.validate_stream import start_validation_stream


def _write(path, lines):
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_validation_stream(spark):
    root = tempfile.mkdtemp(prefix="quarry-stream-")
    inp, out, ckpt = (os.path.join(root, x) for x in ("in", "out", "ckpt"))
    os.makedirs(inp)
    good = '{"instruction": "Explain this code briefly:", "input": "' + "x" * 30 + '", "output": "' + "y" * 20 + '"}'
    _write(os.path.join(inp, "a.jsonl"), [good, "not json", good])
    q = start_validation_stream(spark, inp, out, ckpt, available_now=True)
    q.awaitTermination(120)
    _write(os.path.join(inp, "b.jsonl"), [good, ""])
    q = start_validation_stream(spark, inp, out, ckpt, available_now=True)
    q.awaitTermination(120)
    rows = spark.read.parquet(out).select(F.regexp_extract("file", r"([^/]+)$", 1).alias("f"), "total", "valid",
                                          "invalid").collect()
    got = sorted((r.f, r.total, r.valid, r.invalid) for r in rows)
    assert got == [("a.jsonl", 3, 2, 1), ("b.jsonl", 2, 1, 1)]
