"""Sharding: the permutation against a plain Fisher-Yates, the laws of shards and slots, odd rows."""

import struct
import uuid
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from llm_cases import SMALL, documents, no_documents, odd_documents  # noqa: F401

from ledgerscope.llm import queries, sharding
from ledgerscope.llm.common import table
from ledgerscope.session import shared_dir


class Twister:
    """The generator that Spark's ``shuffle`` draws from, over numpy's Mersenne twister."""

    def __init__(self, seed):
        self.raw = np.random.MT19937()
        self.raw._legacy_seeding(np.array([seed >> 32 & 0xFFFFFFFF, seed & 0xFFFFFFFF], dtype=np.uint32))

    def below(self, n):
        while True:
            bits = int(self.raw.random_raw()) >> 1
            if n & (n - 1) == 0:
                return n * bits >> 31
            if bits - bits % n + n - 1 < 1 << 31:
                return bits % n


def fisher_yates(items, seed):
    draw, out = Twister(seed), []
    for i, x in enumerate(items):
        j = draw.below(i + 1)
        out.append(x)
        if j != i:
            out[i], out[j] = out[j], x
    return out


def plain_bucket(row, buckets, seed):
    h = xxhash.xxh64_intdigest(struct.pack("<i", seed), 42)
    h = xxhash.xxh64_intdigest(struct.pack("<q", row), h)
    return (h - (1 << 64) if h >> 63 else h) % buckets


@pytest.mark.parametrize("buckets", [1, 5, 40])
def test_buckets_are_permuted_by_fisher_yates(spark, buckets):
    rows = [i * 7 + (i % 3 << 33) for i in range(300)]
    records = spark.createDataFrame([(r, (r,)) for r in reversed(rows)], "row long, record struct<doc_id: long>").repartition(3)
    got = {}
    for r in sharding._permuted(records, buckets, 77).collect():
        got.setdefault(r["bucket"], {})[r["at"]] = r["item"]["record"]["doc_id"]
    expected = {}
    for r in sorted(rows):
        expected.setdefault(plain_bucket(r, buckets, 77), []).append(r)
    assert {b: [at[i] for i in range(len(at))] for b, at in got.items()} == {b: fisher_yates(x, 77 + b) for b, x in expected.items()}


def test_query(spark, documents):
    rows = queries.queries()["op11_sharding"](spark, SMALL).collect()
    texts = {d: (t or "").encode() for d, t, _ in documents}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    assert all((r["size"], r["text_crc32"]) == (len(texts[r["doc_id"]]) + 1, zlib.crc32(texts[r["doc_id"]])) for r in rows)
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("rows", None)}
    assert_law(rows, 8)


def assert_law(rows, shards):
    counts = Counter(r["shard"] for r in rows)
    assert max(counts[s] for s in range(shards)) - min(counts[s] for s in range(shards)) <= 1 and set(counts) <= set(range(shards))
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def written(spark, docs, **options):
    return sharding.write_shards(docs, shared_dir(spark, f"test-{uuid.uuid4().hex}"), **options)


@pytest.mark.parametrize("shards, bucket_bytes", [(1, 1 << 30), (3, 10_000), (64, 2_000), (300, 50_000)])
def test_laws_hold_at_any_sizes(spark, shards, bucket_bytes):
    assert_law(sharding.shard_rows(written(spark, table(spark, SMALL, "documents"), shards=shards, bucket_bytes=bucket_bytes)).collect(), shards)


def test_records_come_back_whole_and_in_order(spark, odd_documents):
    out = written(spark, odd_documents.withColumn("slot", odd_documents["doc_id"]).withColumn("record", odd_documents["text"]), shards=4, bucket_bytes=100_000)
    rows = out.select("record.*").select(odd_documents.columns)
    assert sorted(map(str, rows.collect())) == sorted(map(str, odd_documents.collect()))
    assert_law(out.collect(), 4)
    for path in {r["f"] for r in out.selectExpr("_metadata.file_path f").distinct().collect()}:
        slots = [r["slot"] for r in out.where(f"_metadata.file_path = '{path}'").coalesce(1).collect()]
        assert slots == sorted(slots)


def test_same_files_same_shards_and_another_seed_others(spark):
    docs = table(spark, SMALL, "documents")
    runs = [{r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard_rows(written(spark, docs, seed=s, bucket_bytes=40_000)).collect()} for s in (1, 1, 2)]
    assert runs[0] == runs[1] != runs[2]


def test_copies_are_spread(spark):
    docs = spark.createDataFrame([(None, "same")] * 1000 + [(i, "same") for i in range(1000)], "doc_id long, text string")
    rows = sharding.shard_rows(written(spark, docs, bucket_bytes=10_000)).collect()
    without_id = Counter(r["shard"] for r in rows if r["doc_id"] is None)
    assert_law(rows, 8)
    assert all(80 <= without_id[s] <= 170 for s in range(8))


def test_empty_table(spark, no_documents):
    out = written(spark, no_documents)
    assert out.collect() == [] and sharding.shard_rows(out).columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
