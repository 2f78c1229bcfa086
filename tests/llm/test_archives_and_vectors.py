"""WARC bundles, nearest neighbours and the pipeline."""

import io
import random

import numpy as np
import pytest
import zstandard

from listinglake.llm import neighbours, warc
from listinglake.llm.queries import ORACLES, QUERIES

PAGE = "page_id bigint, url string, html string"


def pages_of(spark, rows):
    return spark.createDataFrame(rows, PAGE)


def test_archive_round_trip(spark, tmp_path):
    random.seed(1)
    rows = [(k, f"http://h/{k}", "é<p>" + "x" * random.randint(0, 3_000) * (k % 5)) for k in range(200)]
    rows += [(500, None, None), (501, "u\r\nv", ""), (502, "u", "big" * 400_000), (502, "u", "big" * 400_000)]
    rows += [(None, "n", "alone"), (None, "n", "big" * 400_000)]
    folder = str(tmp_path / "archive")
    warc.write_archive(pages_of(spark, rows).withColumnRenamed("x", "x"), folder)
    found = warc.read_archive(spark, folder).collect()
    assert len(found) == len(rows)
    first = {}
    for page_id, _, html in rows:
        payload = html or ""
        if page_id is not None:
            first[payload] = min(first.get(payload, page_id), page_id)
    text_of = {str(i): (h or "") for i, _, h in rows if i is not None}
    for row in found:
        if row.record == "None":
            assert row.record_type == ("revisit" if row.payload_bytes == 1_200_000 else "response")
            continue
        payload = text_of[row.record]
        origin = first[payload]
        assert row.payload_digest == warc.digest(payload.encode())
        assert row.payload_bytes == len(payload.encode())
        if int(row.record) == origin:
            assert row.record_type == "response" and bytes(row.payload).decode() == payload
            assert row.refers_to is None
        else:
            assert row.record_type == "revisit" and row.refers_to == str(origin)
    # Any Zstandard reader can open a bundle, and the last bytes are the seek table's.
    files = [p for p in (tmp_path / "archive").iterdir() if p.name.startswith("part-")]
    records = 0
    for path in files:
        data = path.read_bytes()
        assert data.endswith(bytes.fromhex("b1ea928f"))
        plain = b"".join(warc.frame_bytes(data, f) for f in warc.seek_table(data)[:-1])
        reader = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True)
        assert reader.read(64) == plain[:64]
        at = 0
        while at < len(plain):
            _, _, at = warc.parse(plain, at)
            records += 1
    assert records == len(rows)
    index = warc.record_index(spark, folder)
    assert index.count() == len(rows)
    wanted = index.where("record in ('7', '500', '501')")
    fetched = {r.record: bytes(r.data) for r in warc.fetch(spark, folder, wanted).collect()}
    assert set(fetched) == {"7", "500", "501"}
    headers, block, _ = warc.parse(fetched["7"], 0)
    assert headers["WARC-Target-URI"] == "http://h/7" and block.decode() == text_of["7"]


def test_least_payload_and_empty_table(spark, tmp_path):
    rows = [(1, "a", "same"), (2, "b", "same"), (3, "c", "longer same"), (4, "d", "longer same")]
    folder = str(tmp_path / "least")
    warc.write_archive(pages_of(spark, rows), folder, least=5)
    kinds = {r.record: r.record_type for r in warc.read_archive(spark, folder).collect()}
    assert kinds == {"1": "response", "2": "response", "3": "response", "4": "revisit"}
    folder = str(tmp_path / "none")
    warc.write_archive(pages_of(spark, []), folder)
    assert warc.read_archive(spark, folder).count() == 0


VECTOR = "vec_id bigint, embedding array<float>, label int"


def brute(rows, k, every):
    good = [
        (i, np.array(v, float))
        for i, v in rows
        if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v) and len(v) == 8
    ]
    found = {}
    for number, vector in good:
        if number % every == 0:
            scores = [
                (-(vector * w).sum() / (np.sqrt((vector**2).sum()) * np.sqrt((w**2).sum())), j)
                for j, w in good
                if j != number
            ]
            found[number] = [j for _, j in sorted(scores)[:k]]
    return found


def test_neighbours_recall_and_exact_scores(spark):
    random = np.random.default_rng(2)
    centres = random.normal(size=(40, 8))
    rows = [
        (k, [float(x) for x in (centres[k % 40] + 0.2 * random.normal(size=8)).astype(np.float32)])
        for k in range(3_000)
    ]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTOR)
    found = neighbours.nearest(frame, every=50)
    expected = brute(rows, 5, 50)
    got = {}
    vectors = {i: np.array(v) for i, v in rows}
    for row in found.orderBy("query_id", "rank").collect():
        got.setdefault(row.query_id, []).append(row.vec_id)
        x, y = vectors[row.query_id], vectors[row.vec_id]
        assert row.score == pytest.approx(x @ y / np.linalg.norm(x) / np.linalg.norm(y), abs=1e-12)
    assert set(got) == set(expected)
    hits = sum(len(set(got[q]) & set(expected[q])) for q in expected)
    assert hits / (5 * len(expected)) >= 0.9


def test_unusable_vectors_ties_and_few_rows(spark):
    one = [1.0] * 8
    rows = [(0, one), (50, one), (1, None), (2, [0.0] * 8), (3, [None] + one[1:]), (4, [float("nan")] * 8)]
    rows += [(5, [float("inf")] * 8), (6, [1.0, 2.0]), (None, one), (9, one), (7, one), (8, [-1.0] * 8)]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTOR)
    got = {}
    for row in neighbours.nearest(frame).orderBy("query_id", "rank").collect():
        got.setdefault(row.query_id, []).append(row.vec_id)
    assert got == {0: [7, 9, 50, 8], 50: [0, 7, 9, 8]}
    assert neighbours.nearest(frame.where("vec_id = 1")).count() == 0
    assert neighbours.nearest(frame.where("false")).count() == 0


def test_parts_are_balanced():
    rows = neighbours.unit(np.random.default_rng(1).normal(size=(500, 8)))
    graph = neighbours.neighbour_graph(rows, 10)
    label = neighbours.balanced_parts(rows, graph, 8)
    assert np.bincount(label, minlength=8).max() <= -(-500 // 8)
    chance = (np.random.default_rng(2).permutation(label)[graph] == label[:, None]).mean()
    assert (label[graph] == label[:, None]).mean() > 2 * chance


def test_all_queries_are_registered():
    from __spark_entry__ import oracle_sql, queries

    numbers = {int(name[2:].split("_")[0]) for name in QUERIES}
    assert numbers == set(range(1, 14))
    assert set(QUERIES) <= set(queries()) and "pipeline" in queries()
    assert set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    folder = "/root/testdata/sf0.01"
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        connection.sql(f"create view {table} as select * from '{folder}/{table}.parquet'")
    relation = connection.sql(ORACLES[name])
    columns = sorted(relation.columns)
    expected = sorted(map(str, relation.select(*columns).fetchall()))
    found = QUERIES[name](spark, folder)
    assert sorted(found.columns) == columns
    assert sorted(str(tuple(row)) for row in found.select(*columns).collect()) == expected


def test_pipeline_keeps_what_each_stage_should(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    docs = documents
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.store(stage(spark, docs, folder), "test-stage")
        if name != "mix":
            assert docs.columns == documents.columns
        if name == "personal_data":
            assert docs.count() == before.count()
        else:
            assert docs.join(before, "doc_id", "left_anti").count() == 0
    assert 0 < docs.count() < documents.count()
    empty = documents.where("false")
    for _, stage in corpus_pipeline.STAGES:
        empty = corpus_pipeline.store(stage(spark, empty, folder), "test-stage")
        assert empty.count() == 0
