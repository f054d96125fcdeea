"""Operators on documents against brute force, and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spindrift.llm import fertility, mixing, packing, passages, simhash, suffix_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BPE, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")


def sentences(seed, words):
    pick = random.Random(seed)
    made = ["".join(pick.choice("abcdefgh") for _ in range(pick.randint(2, 8))) for _ in range(400)]
    return " ".join(pick.choice(made) for _ in range(words))


def rows_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def fingerprint(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)] * bool(words)
    count = Counter()
    for s, n in Counter(shingles).items():
        h = xxhash.xxh64(s.encode(), seed=42).intdigest()
        count.update({b: n for b in range(64) if h >> b & 1})
    return sum(1 << b for b in range(64) if 2 * count[b] > len(shingles))


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_simhash_links_all_within_the_radius(table, request):
    df = request.getfixturevalue(table)
    docs = rows_of(df)
    prints = [fingerprint(t) for _, t in docs]
    group = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4 and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    least = defaultdict(list)
    for (doc, _), g in zip(docs, group):
        least[g] += [doc] if doc is not None else []
    want = Counter((d, f"{p:016x}", min(least[g], default=None)) for (d, _), p, g in zip(docs, prints, group))
    assert Counter(map(tuple, simhash.near_duplicates(df).collect())) == want
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _, c in want if d is None or d == c}


def test_large_shards_meet_part_by_part(spark):
    random = np.random.default_rng(1)
    centre = random.integers(0, 1 << 63, 3, dtype=np.int64)
    values = {int(c) ^ sum(1 << int(b) for b in random.integers(0, 63, 5)) for c in centre for _ in range(120)}
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    edges = simhash.links(fps, shard_rows=50).collect()
    every = sorted(values)
    def groups(pairs):
        of = {v: v for v in every}
        for a, b in pairs:
            if of[a] != of[b]:
                old, new = max(of[a], of[b]), min(of[a], of[b])
                of = {k: new if g == old else g for k, g in of.items()}
        return of
    within = [(a, b) for i, a in enumerate(every) for b in every[:i] if (a ^ b).bit_count() <= 4]
    assert all(((a ^ b) & ((1 << 64) - 1)).bit_count() <= 4 for a, b in edges)
    assert groups([tuple(e) for e in edges]) == groups(within)


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 1000}])
@pytest.mark.parametrize("table", ["documents", "odd"])
def test_repeats_are_removed_exactly(table, options, request):
    df = request.getfixturevalue(table).where("length(text) < 100000 or text is null")
    seen, want = set(), Counter()
    for doc, text in sorted(set(rows_of(df)), key=lambda r: (r[0] is None, r[0])):
        body = text.encode()
        gone = bytearray(len(body))
        for i in range(len(body) - 99):
            if body[i:i + 100] in seen:
                gone[i:i + 100] = b"\1" * 100
            seen.add(body[i:i + 100])
        left = bytes(b for b, g in zip(body, gone) if not g)
        want[doc] = (len(body), sum(gone), sum(map(bool, bytes(gone).split(b"\0"))), hashlib.sha256(left).hexdigest())
    got = suffix_dedup.digest(df, **options).collect()
    assert len(got) == df.count() and {r[0]: tuple(r)[1:] for r in got} == want
    cut = suffix_dedup.without_repeats(df)
    assert cut.columns == df.columns and cut.count() == df.count()
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in cut.collect())


def test_suffixes_are_sorted():
    pieces = [b"banana", b"", b"\0\0a", b"banana", b"aaaa\xff\xff\0", b"mississippi"]
    order, text, piece, left = suffix_dedup.suffix_order(pieces)
    stop = {i: int(p) for i, p in enumerate(np.searchsorted(piece, np.arange(len(pieces))))}
    got = [pieces[piece[i]][i - stop[int(piece[i])]:] for i in order.tolist()]
    assert got == sorted(p[k:] for p in pieces for k in range(len(p)))


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_packing_round_trip(table, request):
    df = request.getfixturevalue(table)
    tokenizer = Tokenizer.from_file(BPE)
    want = Counter()
    for doc, text in rows_of(df):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], dtype="<u4")
        want[doc, len(ids)] += 1
    got = packing.pack(df, BPE).collect()
    assert Counter((r.doc_id, r.doc_tokens) for r in got if r.start == 0) == want
    by_sequence = defaultdict(list)
    for r in got:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    fills = []
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        fills.append(at)
    assert all(f == 4096 or f & (f - 1) == 0 for f in fills) and max(fills) <= 4096
    texts = dict(rows_of(df))
    for doc in list(texts)[:40]:
        ids = np.array([*tokenizer.encode(texts[doc], add_special_tokens=False).ids, 2], dtype="<u4")
        for r in got:
            if r.doc_id == doc and r.doc_tokens == len(ids):
                assert zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32


def test_few_tokens_are_poured_however_the_table_is_dealt(spark):
    documents = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").repartition(8)
    shares = {r["poured"]: r["n"] for r in packing.pack(documents, BPE).groupBy("poured").agg(
        F.sum("length").alias("n")).collect()}
    assert shares[True] <= 0.05 * sum(shares.values())


@pytest.mark.parametrize("fan_in, most_open", [(2, 4096), (2, 3), (8, 40)])
def test_rounds_and_bounds_keep_every_token(spark, documents, fan_in, most_open):
    want = {r["d"]: (r["n"], r["tokens"]) for r in packing.pack(documents.coalesce(1), BPE).groupBy(
        F.col("doc_id").alias("d")).agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("tokens")).collect()}
    got = packing.pack(documents.repartition(9), BPE, fan_in=fan_in, most_open=most_open).collect()
    ends = defaultdict(int)
    for r in sorted(got, key=lambda r: (r.doc_id, r.start)):
        assert r.start == ends[r.doc_id]
        ends[r.doc_id] += r.length
    assert {d: (n, n) for d, n in ends.items()} == want
    fills = Counter()
    for r in got:
        fills[r.sequence_id] += r.length
    assert sum(f != 4096 for f in fills.values()) <= 12 and all(f == 4096 or f & (f - 1) == 0 for f in fills.values())


def test_a_level_minimises_the_sum_of_squares():
    closed = []
    packer = packing.LevelPacker(16, closed.append)
    random = np.random.default_rng(5)
    for size in random.integers(1, 17, 300).tolist():
        counts = packer.counts.copy()
        best = {}
        for level in [0, *np.flatnonzero(counts[1:16]) + 1]:
            if level + size > 16:
                continue
            after = counts.copy()
            after[level] -= level > 0
            after[level + size] += level + size < 16
            best[level] = int((after ** 2).sum())
        level = packer.best_level(size)
        assert best[level] == min(best.values())
        packer.place(("x", 0, np.zeros(size, np.uint32), size))
    packer.drain()
    assert all((n := sum(len(p[2]) for p in w)) == 16 or n & (n - 1) == 0 for w in closed)


CLEAN = {
    "arabic": "يولد جميع الناس أحرارا متساوين في الكرامة والحقوق، وقد وهبوا عقلا وضميرا وعليهم أن يعامل بعضهم بعضا بروح الإخاء.",
    "hebrew": "כל בני האדם נולדו בני חורין ושווים בערכם ובזכויותיהם. כולם חוננו בתבונה ובמצפון, לפיכך חובה עליהם לנהוג איש ברעהו.",
    "indic": "सभी मनुष्यों को गौरव और अधिकारों के मामले में जन्मजात स्वतन्त्रता और समानता प्राप्त है। उन्हें बुद्धि और अन्तरात्मा की देन प्राप्त है",
    "thai": "มนุษย์ทั้งหลาย เกิดมา มีอิสระ และ เสมอภาคกัน ใน เกียรติศักดิ์ และ สิทธิ ต่างมี เหตุผล และ มโนธรรม และ ควรปฏิบัติ ต่อกัน",
    "cjk": "人人 生而 自由， 在 尊严 和 权利 上 一律 平等。 他们 赋有 理性 和 良心， 并应 以 兄弟 关系 的 精神 相 对待。",
    "hangul": "모든 인간은 태어날 때부터 자유로우며 그 존엄과 권리에 있어 동등하다. 인간은 천부적으로 이성과 양심을 부여받았으며 서로",
    "caucasian": "ყველა ადამიანი იბადება თავისუფალი და თანასწორი თავისი ღირსებითა და უფლებებით. მათ მინიჭებული აქვთ გონება და სინდისი",
}
RANGES = {"arabic": (0x600, 0x6FF), "hebrew": (0x591, 0x5F4), "indic": (0x900, 0xDFF), "thai": (0xE01, 0xE5B),
          "cjk": (0x4E00, 0x9FFF), "hangul": (0xAC00, 0xD7A3)}


def test_bands_tell_clean_text_from_random_letters(spark):
    pick = random.Random(4)
    rows = [(i, text) for i, text in enumerate(CLEAN.values())]
    rows += [(100 + i, " ".join("".join(chr(pick.randint(*r)) for _ in range(5)) for _ in range(40)))
             for i, r in enumerate(RANGES.values())]
    rows.append((200, " ".join(chr(0x1F300 + i) for i in range(60))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in fertility.judge(df, PIECES).collect()}
    assert [got[i]["script"] for i in range(len(CLEAN))] == list(CLEAN)
    assert [got[100 + i]["script"] for i in range(len(RANGES))] == list(RANGES)
    assert not any(r["base_failed"] for r in got.values())
    assert {i for i, r in got.items() if r["kept"]} == set(range(len(CLEAN)))


def quality_counts(text):
    words, lines, seen, dup = WORD.findall(text), text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed)


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_rule_counts(table, request):
    df = request.getfixturevalue(table)
    want = Counter((d, *quality_counts(t)) for d, t in rows_of(df))
    got = fertility.judge(df, PIECES).collect()
    assert Counter(tuple(r)[:7] for r in got) == want
    assert not any(r.kept and r.base_failed for r in got)


def test_rules_keep_good_documents(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").where("quality = 1")
    got = fertility.judge(documents, PIECES).join(labels, "doc_id").where("not base_failed").collect()
    assert len(got) > 40 and all(r.kept for r in got)


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_mix_meets_targets(table, request):
    df = request.getfixturevalue(table)
    got = mixing.mix(df).collect()
    sizes = Counter()
    for r in df.select("doc_id", "text", "source").collect():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, total = {}, sum(sizes.values())
    free, left = set(order), float(total)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        target |= {s: 3.0 * sizes[s] for s in over}
        left, free = left - sum(3.0 * sizes[s] for s in over), free - over
    taken, largest = Counter(), Counter()
    for r in got:
        assert abs(r.target - target[r.source]) < 1e-6 and r.source_size == sizes[r.source]
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    assert len(got) == df.count()
    assert all(abs(taken[s] - target[s]) <= 1.01 * largest[s] for s in order)
    assert Counter(map(tuple, mixing.mix(df, rows_per_slice=40).collect())) == Counter(map(tuple, got))
    mixed = mixing.mixed(df)
    assert mixed.columns == df.columns
    assert mixed.count() == sum(r.copies if r.doc_id is not None else 1 for r in got)


def test_passages(spark, odd):
    shared, other = sentences(1, 80), sentences(2, 120)
    edited = shared.split()
    edited[30:32] = ["new"]
    rows = [(10, sentences(3, 50) + " " + shared), (11, shared + " " + sentences(4, 90)), (12, other),
            (13, sentences(5, 20) + " " + " ".join(edited)), (14, sentences(6, 70) + " " + other[:200]), (15, None)]
    df = odd.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    got = [r for r in passages.shared_passages(df).collect() if r.doc_id >= 10]
    assert {d for r in got for d in (r.doc_id, r.other_id)} == {10, 11, 13}
    assert all(r.similarity >= 0.8 and r.end_word - r.start_word >= 50 for r in got)


def test_chains_are_the_best_by_brute_force():
    random = np.random.default_rng(3)
    for _ in range(30):
        points = sorted({tuple(p) for p in random.integers(0, 60, (14, 2)).tolist()})
        a, b = (np.array(x) for x in zip(*points))
        best = [0.0] * len(points)
        for i in range(len(points)):
            best[i] = 5 + max([0.0] + [best[j] - 0.1 * (a[i] - a[j] + b[i] - b[j])
                                       for j in range(i) if a[j] < a[i] and b[j] < b[i]])
        chain = passages.chains(a, b)[0]
        score = 5 * len(chain) - 0.1 * (a[chain[-1]] - a[chain[0]] + b[chain[-1]] - b[chain[0]])
        assert abs(score - max(best)) < 1e-9


def test_empty_tables(odd):
    none = odd.where("doc_id = -1")
    for df in (simhash.near_duplicates(none), suffix_dedup.digest(none), packing.pack(none, BPE),
               fertility.judge(none, PIECES), mixing.mix(none), mixing.mixed(none),
               passages.shared_passages(none), suffix_dedup.without_repeats(none)):
        assert df.count() == 0
