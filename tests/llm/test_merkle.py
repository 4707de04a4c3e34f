"""The manifest against plainly built trees, and against its SQL; odd rows; what a changed text does."""

import hashlib
import random
import zlib

import pytest
from llm_cases import DOC_SCHEMA, SMALL, no_documents, odd_documents  # noqa: F401
from pyspark.sql import functions as F

from ledgerscope.llm import merkle, queries
from oracle_harness import compare, duck


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def said(*values):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def plain_paths(digests):
    """Levels of siblings (left, right) for each leaf, and the top."""
    paths, at = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for path, i in zip(paths, at, strict=True):
            start = i // 8 * 8
            path.append((digests[start:i], digests[i + 1 : start + 8]))
        at = [i // 8 for i in at]
        digests = [sha("".join(digests[i : i + 8])) for i in range(0, len(digests), 8)]
    return paths, digests[0]


def plain(rows):
    """rows: (doc_id, source, lang, n_chars, text); the result rows as a sorted list."""
    trees = {}
    for doc_id, source, lang, n_chars, text in rows:
        change = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        lower = text if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        leaf, claimed = (sha(said(doc_id, source, lang, n_chars, t)) for t in (text, lower if change else text))
        trees.setdefault(lang, []).append((doc_id is None, doc_id or 0, leaf, doc_id, claimed))
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    within = {lang: plain_paths([x[2] for x in sorted(trees[lang], key=lambda x: x[:3])]) for lang in order}
    upper, root = plain_paths([within[lang][1] for lang in order])
    out = []
    for lang, above in zip(order, upper, strict=True):
        paths, subroot = within[lang]
        for (*_, leaf, doc_id, claimed), path in zip(sorted(trees[lang], key=lambda x: x[:3]), paths, strict=True):
            folded, proof = claimed, ""
            for left, right in path + above:
                folded = sha("".join(left) + folded + "".join(right))
                proof += "".join(left) + "".join(right)
            out.append((doc_id, leaf, subroot, root, sha(proof), folded, folded == root))
    return sorted(out, key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def got(docs):
    return sorted(map(tuple, merkle.verify_rows(docs).collect()), key=str)


@pytest.mark.parametrize("size", [1, 2, 7, 8, 9, 64, 65, 513, 600])
def test_trees_of_any_size(spark, size):
    rng = random.Random(size)
    langs = ["de", None, "ä", "z", "en", "EN", "", "fr", "es", "it"][: 1 + size % 11]
    ids = rng.sample(range(-50, 10**6), size)
    rows = [(i, rng.choice(["web", None]), rng.choice(langs), rng.choice([None, i]), rng.choice(["Some Text", "none", None, "É x", ""])) for i in ids]
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(5)) == plain(rows)


def test_many_languages_and_a_large_one(spark, monkeypatch):
    monkeypatch.setattr(merkle, "FEW_ROWS", 50)
    monkeypatch.setattr(merkle, "BROADCAST_LANGS", 20)
    rows = [(i, "s", f"l{i % 75}" if i % 3 else "most", None, f"Text {i}") for i in range(700)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_query_against_its_sql(spark):
    res = compare(queries.queries()["op12_manifest"](spark, SMALL), duck(SMALL), queries.oracle_sql()["op12_manifest"])
    assert res["ok"], res


def test_odd_rows(spark, odd_documents, no_documents):
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    assert got(odd_documents) == plain([tuple(r) for r in odd_documents.select(columns).collect()])
    assert got(no_documents) == [] and merkle.Manifest(no_documents).root is None
    same = spark.createDataFrame([(None, None, None, None, None)] * 20, SCHEMA)
    assert got(same) == plain([(None,) * 5] * 20)


def test_a_false_claim_is_found(spark, odd_documents):
    proofs = merkle.Manifest(odd_documents, F.when(F.col("doc_id") == 6, F.concat("text", F.lit("!"))).otherwise(F.col("text"))).proofs()
    rows = proofs.select("doc_id", (merkle.fold(F.col("claimed"), F.col("path")) == F.col("root")).alias("ok")).collect()
    assert {r["doc_id"] for r in rows if not r["ok"]} == {6} and len(rows) == odd_documents.count()


def test_nodes_cover_their_ranks(spark):
    docs = spark.createDataFrame([(i, "s", "en" if i % 4 else None, i, "t") for i in range(300)], SCHEMA)
    nodes = merkle.Manifest(docs).nodes().collect()
    for lang, n in (("en", 225), (None, 75)):
        for level in range(4):
            spans = sorted((r["lo"], r["hi"]) for r in nodes if r["lang"] == lang and r["level"] == level)
            assert not spans or (spans[0][0] == 0 and spans[-1][1] == n and all(a[1] == b[0] for a, b in zip(spans, spans[1:])))
    assert sorted(r["level"] for r in nodes if r["hi"] - r["lo"] in (225, 75)) == [3, 3]
