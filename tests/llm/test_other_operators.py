"""Archives, neighbours, learned operators and the pipeline."""

import glob
import gzip
import hashlib
import subprocess
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from spindrift.llm import language, mixing, neighbours, quality, queries, warc
from spindrift.llm.shared import fresh_path

TABLES = "/root/testdata/sf0.001"


def test_archives_round_trip(spark, tmp_path):
    same, short = "<p>" + "x" * 200, "short"
    rows = [(1, "u", same), (2, None, same), (3, "a\r\nb%0A", None), (4, "u", short), (5, "u", short),
            (None, "n", same), (6, "u", "y" * 300_000 + "é"), (1, "again", same), (7, "\0", "\0\n\r\n\r\n" * 50)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string")
    path = fresh_path(spark, "test")
    warc.write_archives(df, path, records_per_file=2)
    got = warc.read_archives(spark, path).collect()
    assert Counter((r.page_id, r.url) for r in got) == Counter((i, u) for i, u, _ in rows)
    for r in got:
        html = next((h or "").encode() for i, u, h in rows if (i, u) == (r.page_id, r.url))
        revisit = (r.page_id, r.url) in {(2, None), (None, "n")}
        assert (r.record_type, r.refers_to) == (("revisit", 1) if revisit else ("response", None))
        assert r.payload_bytes == len(html) and r.payload_digest == hashlib.sha256(html).hexdigest()
        assert r.payload is None if revisit else bytes(r.payload) == html
    assert warc.archived(df.where("page_id < 0")).count() == 0


def archive_bytes(path):
    return [open(f, "rb").read() for f in sorted(glob.glob(f"{path}/part-*"))]


def test_any_reader_of_gzip_takes_a_large_record(spark):
    big = 17 << 20  # its size has a high byte that is not zero
    df = spark.range(3).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.when(
        F.col("id") == 1, F.expr(f"repeat('x', {big})")).otherwise(F.concat(F.lit("page "), "id")).alias("html"))
    path = fresh_path(spark, "test")
    warc.write_archives(df.coalesce(1), path)
    [body] = archive_bytes(path)
    assert gzip.decompress(body).count(b"WARC/1.1\r\n") == 3
    assert subprocess.run(["gzip", "-t"], input=body, capture_output=True).returncode == 0
    got = {r.page_id: r.n for r in warc.read_archives(spark, path).select("page_id", F.length("payload").alias("n")).collect()}
    assert got == {0: 6, 1: big, 2: 6}


def test_archives_are_bounded_by_bytes(spark):
    noise = np.random.default_rng(1)
    sizes = [20_000] * 30 + [10] * 60 + [90_000] * 3
    rows = [(i, "u", noise.integers(32, 127, n, np.uint8).tobytes().decode()) for i, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    path = fresh_path(spark, "test")
    warc.write_archives(df, path, records_per_file=40, file_bytes=100_000)
    bodies = archive_bytes(path)
    assert all(len(b) <= 100_000 + 90_000 for b in bodies) and len(bodies) >= 6
    assert all(gzip.decompress(b).count(b"WARC/1.1\r\n") <= 40 for b in bodies)
    got = {r.page_id: bytes(r.payload).decode() for r in warc.read_archives(spark, path).collect()}
    assert got == {i: html for i, _, html in rows}


def test_reader_takes_chunks_of_any_size_and_rejects_damage():
    one = warc.member([("WARC-Block-Digest", "sha256:" + hashlib.sha256(b"hello").hexdigest())], b"hello")
    two = warc.member([], b"\r\n\r\n" * 9)
    body = one + b"\0" + two + b"\0\0"
    for size in (1, 7, 1000):
        blocks = [r.block for r in warc.read(body[i:i + size] for i in range(0, len(body), size))]
        assert blocks == [b"hello", b"\r\n\r\n" * 9]
    bad = warc.member([("WARC-Block-Digest", "sha256:0")], b"hello")
    for broken in (bad, one[:-9]):
        with pytest.raises(ValueError):
            list(warc.read([broken]))


def test_hilbert_steps_go_to_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
        keys = neighbours.hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def exact(ids, vectors, n):
    found = {}
    for q in ids[ids % 20 == 0]:
        scores = vectors @ vectors[np.flatnonzero(ids == q)[0]]
        order = [i for i in np.lexsort((ids, -np.round(scores, 12))) if ids[i] != q]
        found[int(q)] = [(int(ids[i]), scores[i]) for i in order[:n]]
    return found


def test_neighbours_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = table.collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    want, hits = exact(ids, vectors, 20), 0
    got = defaultdict(list)
    for r in queries.QUERIES["op5_hilbert_neighbours"](spark, "/root/testdata/sf0.1").collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    for q, expected in want.items():
        found = sorted(got[q])
        assert [r for r, _, _ in found] == list(range(1, 21))
        hits += len({i for i, _ in expected} & {i for _, i, _ in found})
    assert hits >= 0.9 * 20 * len(want)


def test_the_window_follows_the_structure_of_the_vectors(spark, monkeypatch):
    random, halves = np.random.default_rng(8), {}
    measure = neighbours.window_for
    flat = random.normal(size=(12_000, 3)) @ random.normal(size=(3, 32))
    spread = random.normal(size=(12_000, 32))
    for name, vectors in (("flat", flat), ("spread", spread)):
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
        monkeypatch.setattr(neighbours, "window_for", lambda *a, **k: halves.setdefault(name, measure(*a, **k)))
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
        got = neighbours.nearest(df, F.col("id") % 100 == 0, least_window=16).collect()
        found = defaultdict(set)
        for r in got:
            found[r.query_id].add(r.vec_id)
        hits = 0
        for q in range(0, 12_000, 100):
            scores = vectors @ vectors[q]
            scores[q] = -np.inf
            hits += len(found[q] & set(np.argsort(-scores)[:20].tolist()))
        assert hits >= 0.9 * 20 * 120
    assert halves["flat"] <= 0.01 * 12_000 < halves["spread"]


def test_odd_vectors(spark):
    random = np.random.default_rng(2)
    rows = [(i, random.normal(size=4).tolist()) for i in range(60)] + [(100 + i, [1.0, 2.0, 0.0, 0.0]) for i in range(70)]
    odd = [(200, None), (201, [0.0] * 4), (202, [None, 1.0, 1.0, 1.0]), (203, [float("nan")] * 4),
           (204, [float("inf"), 0.0, 0.0, 0.0]), (205, [1.0, 2.0]), (None, [1.0] * 4), (220, None), (5, rows[5][1])]
    df = spark.createDataFrame([(*r, 1) for r in rows + odd], "vec_id long, embedding array<double>, score int")
    got = defaultdict(list)
    for r in neighbours.nearest(df, F.col("id") % 20 == 0).collect():
        got[r.query_id].append((r["rank"], r.vec_id))
    ids, vectors = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    assert {q: [i for _, i in sorted(f)] for q, f in got.items()} == {
        q: [i for i, _ in f] for q, f in exact(ids, vectors, 20).items()}
    assert neighbours.nearest(df.where("vec_id < 0"), F.col("id") % 20 == 0).count() == 0


def test_languages_of_held_out_documents(spark, odd):
    got = queries.QUERIES["op8_language"](spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").where("held_out and lang_pred <> 'und'").collect()
    assert len(rows) > 100 and sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    model = language.learn(odd)
    found = language.identify(odd, model).collect()
    assert len(found) == odd.count()
    for r in found:
        assert (r.lang_pred == "und") == (r.doc_id in (1, 2, 3, 4))
    assert language.identify(odd, language.learn(odd.where("doc_id = -1"))).where("lang_pred <> 'und'").count() == 0


def test_code_lengths_by_the_book():
    counts = {}
    texts = {"x": b"abracadabra abracadabra" * 4, "y": b"hocus pocus hocus" * 5}
    for lang, text in texts.items():
        led = b"\n\n\n" + text
        grams = Counter(int.from_bytes(led[i:i + 4], "big") for i in range(len(led) - 3))
        counts[lang] = (np.array(list(grams)), np.array(list(grams.values())))
    model = language.compile_model(counts, least=3)
    def bits(lang, text):
        gram, n = counts[lang]
        seen = [Counter() for _ in range(4)]
        for g, k in zip(gram.tolist(), n.tolist()):
            b = model.symbol[list(g.to_bytes(4, "big"))].tolist()
            for order in range(4):
                seen[order][tuple(b[3 - order:3]), b[3]] += k
        def chances(context):
            if context is None:
                return [1 / 128] * 128
            row = [seen[len(context)][context, s] for s in range(128)]
            shorter = chances(context[1:] if context else None)
            total, kinds = sum(row), sum(map(bool, row))
            if not kinds or (context and total < 3):
                return shorter
            rest = sum(p for p, c in zip(shorter, row) if not c)
            return [c / (total + kinds) if c else kinds / (total + kinds) * p / rest for p, c in zip(shorter, row)]
        led = model.symbol[list(b"\n\n\n" + text)].tolist()
        return sum(-np.log2(chances(tuple(led[i - 3:i]))[led[i]]) + (np.log2(129) if led[i] == 0 else 0)
                   for i in range(3, len(led)))
    probe = b"abra hocus zz"
    got = language.code_lengths([probe, b""], model)
    assert got[1].tolist() == [0, 0]
    assert np.allclose(got[0], [bits(k, probe) for k in model.languages], rtol=1e-4)


def test_quality_of_held_out_documents(spark, odd):
    folder = "/root/testdata/sf0.1"
    got = queries.QUERIES["op10_quality"](spark, folder)
    rows = got.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").collect()
    good = [r.predicted for r in rows if r.quality == 1]
    poor = [r.predicted for r in rows if r.quality == 0]
    assert sum(good) >= 0.97 * len(good) and sum(poor) <= 0.1 * len(poor) and len(poor) > 50
    labels = spark.createDataFrame([(5, 0), (6, 1), (7, 1), (8, 1), (1, 0), (2, None)], "doc_id long, quality int")
    net = quality.learn(odd, labels)
    assert quality.score(odd, net).count() == odd.count() == quality.score(odd, None).count()
    assert quality.accepted(odd, net, threshold=0.0).collect() and quality.accepted(odd, net).columns == odd.columns
    assert quality.learn(odd, labels.where("quality = 1")) is None


def test_gradients():
    random = np.random.default_rng(4)
    x, counts, labels = random.normal(size=(9, 6)), np.array([2, 1, 4, 2]), np.array([0, 1, 1, 0])
    net = {"w": random.normal(size=(6, 5)), "b": random.normal(size=5), "v": random.normal(size=(5, 3)),
           "u": random.normal(size=(5, 3)), "a": random.normal(size=3), "c": random.normal(size=5), "d": np.zeros(1)}
    def loss():
        s = quality._sigmoid(quality._forward(net, x, counts)[0])
        return -(labels * np.log(s) + (1 - labels) * np.log(1 - s)).sum()
    score, held = quality._forward(net, x, counts)
    found = quality._gradients(net, x, counts, quality._sigmoid(score) - labels, held)
    for name, value in net.items():
        flat = value.reshape(-1)
        for i in range(0, len(flat), 4):
            kept = flat[i]
            flat[i] = kept + 1e-6
            up = loss()
            flat[i] = kept - 1e-6
            down = loss()
            flat[i] = kept
            assert abs((up - down) / 2e-6 - found[name].reshape(-1)[i]) < 1e-5, name


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, TABLES)
        assert after.columns == docs.columns, name
        assert after.select("doc_id").subtract(docs.select("doc_id")).isEmpty(), name
        docs = spark.createDataFrame(after.collect(), after.schema)
        assert docs.count() > 0, name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, TABLES)
    whole = corpus_pipeline.run(spark, TABLES)
    key = ["doc_id", "doc_tokens"]
    assert packed.where("start = 0").groupBy(*key).count().exceptAll(
        whole.where("start = 0").groupBy(*key).count()).count() == 0


def test_mixed_takes_repeated_ids_as_often_as_the_mix_says(spark):
    rows = [(i % 40, f"w{i} " * (1 + i % 7), "en", f"s{i % 3}", i) for i in range(150)] + [(3, "same", "en", "s0", 1)] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    copies = {r["doc_id"]: r["n"] for r in mixing.mix(df).groupBy("doc_id").agg(F.sum("copies").alias("n")).collect()}
    for limit in (200_000, 4):
        out = mixing.mixed(df, rows_per_slice=limit)
        taken = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
        assert taken == {i: n for i, n in copies.items() if n}
        most, held = Counter(map(tuple, out.collect())), Counter(rows)
        for row, n in most.items():
            assert n <= held[row] * -(-copies[row[0]] // sum(r[0] == row[0] for r in rows))
