import base64
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from martlake.llm import ann, warc
from martlake.session import scratch_path


def test_archive(spark):
    rows = [(3, "http://c", b"same"), (1, "http://a\r\nx", b"same"), (2, None, b"\xff\x00\r\n\r\n"), (4, "http://d", None),
            (5, "http://e", b""), (None, "http://f", b"same"), (1, "http://a\r\nx", b"same"), (6, "http://g", b"long" * 99_999)]
    df = spark.createDataFrame(rows, "id long, uri string, payload binary").withColumn("digest", F.lit("x"))
    folder = scratch_path(spark, "warc")
    warc.write_archive(df, folder)
    assert spark.read.parquet(f"{folder}/payloads").count() == 4
    got = warc.read_digests(spark, folder).collect()
    assert len(got) == len(rows)
    for r in got:
        payload = next(p or b"" for i, _, p in rows if i == r.id)
        assert r.payload_bytes == len(payload) and r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
    kinds = sorted((r.id or 99, r.record_type, r.refers_to) for r in got)
    assert kinds == [(1, "response", None), (1, "revisit", 1), (2, "response", None), (3, "revisit", 1), (4, "response", None),
                     (5, "revisit", 4), (6, "response", None), (99, "revisit", 1)]
    warc.write_archive(df, large := scratch_path(spark, "warc"), min_bytes=5)
    assert warc.read_digests(spark, large).where("record_type = 'revisit'").count() == 0

    whole = {(r.id, bytes(r.payload)) for r in warc.read_archive(spark, folder).collect()}
    assert whole == {(i, p or b"") for i, _, p in rows}
    out = scratch_path(spark, "out")
    warc.export_warc(spark, folder, out)
    back = warc.read_warc(spark, out).collect()
    assert len(back) == len(rows) and all(r.header.startswith(b"WARC/1.1\r\n") for r in back)
    assert sorted(bytes(r.block) for r in back) == sorted([b"same", b"\xff\x00\r\n\r\n", b"", b"long" * 99_999, b"", b"", b"", b""])

    (spark.read.parquet(f"{folder}/payloads").withColumn("payload", F.lit(b"spoiled")).write
     .parquet(f"{(bad := scratch_path(spark, 'bad'))}/payloads"))
    spark.read.parquet(f"{folder}/records").write.parquet(f"{bad}/records")
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_digests(spark, bad).collect()
    warc.write_archive(df.limit(0), nothing := scratch_path(spark, "warc"))
    assert warc.read_digests(spark, nothing).count() == 0


def vectors(spark, n, dim=24):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((n, dim)) + 3 * np.eye(dim)[rng.integers(0, 8, n)]
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    rows += [(5000 + k, x[0].tolist()) for k in range(300)]  # a crowd of equal vectors
    rows += [(9000, None), (9050, [0.0] * dim), (9100, [None] + [1.0] * (dim - 1)), (9150, [float("nan")] * dim),
             (9200, [float("inf")] * dim), (9250, [1.0, 2.0]), (None, x[1].tolist()), (50, x[50].tolist())]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("list", F.lit(1))


def test_nearest_against_brute_force(spark):
    rows, df = vectors(spark, 1500)
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    good = {i: np.array(v) for i, v in rows if i is not None and (i < 9000)}
    ids, x = np.array(sorted(good)), np.array([good[i] for i in sorted(good)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hit = total = 0
    queries = [i for i in ids.tolist() if i % 50 == 0]
    assert set(got) == set(queries)
    for q in queries:
        score = np.round(x @ x[np.searchsorted(ids, q)], 12)
        score[ids == q] = -2
        want = ids[np.lexsort((ids, -score))[:5]].tolist()
        found = [got[q][k][0] for k in range(1, 6)]
        hit, total = hit + len(set(found) & set(want)), total + 5
        assert all(abs(score[np.searchsorted(ids, v)] - s) < 1e-9 for v, s in got[q].values())
    assert hit >= 0.9 * total
    assert [got[0][k][0] for k in range(1, 6)] == [5000, 5001, 5002, 5003, 5004]


def test_nearest_of_few(spark):
    _, df = vectors(spark, 60)
    assert ann.nearest(df.where("vec_id < 3"), F.col("vec_id") == 0).count() == 2
    assert ann.nearest(df.limit(0), F.col("vec_id") == 0).count() == 0


def test_abandoning_keeps_the_nearest():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((5000, 64))
    turn, q, ids = ann.rotation(64), rng.standard_normal(64), np.arange(5000)
    unit = ann.unit(x) @ turn
    found, _ = ann.scan(ids, x, unit, -1, q, ann.unit(q[None])[0] @ turn, 5)
    assert len(set(found) & set(np.argsort(-ann.cosines(x, q))[:5])) >= 4
