"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns: every operator and stage."""

import pytest
from llm_cases import SMALL, no_documents, odd_documents  # noqa: F401

import corpus_pipeline
from ledgerscope.llm import decontam, exact_dedup, langid, line_dedup, lm, pieces, pii, simhash, token_counts, toxicity
from ledgerscope.llm.common import table


def _toxic_model():
    return toxicity.Model({}, -2.0)


OPERATORS = {
    "simhash": simhash.near_duplicates,
    "token_counts": token_counts.count_tokens,
    "langid": lambda docs: langid.identify(docs, langid.learn(docs)),
    "lm": lm.score_texts,
    "line_dedup": line_dedup.line_report,
    "pii": pii.find_personal_data,
    "exact_dedup": exact_dedup.exact_groups,
    "pieces": pieces.round_trip,
    "toxicity": lambda docs: toxicity.score_texts(docs, _toxic_model()),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_one_row_for_every_row(name, odd_documents):
    rows = OPERATORS[name](odd_documents).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r["doc_id"]) for r in odd_documents.select("doc_id").collect())


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(name, no_documents):
    assert OPERATORS[name](no_documents).collect() == []


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_on_odd_and_empty_input(name, stage, spark, odd_documents, no_documents):
    out = stage(spark, odd_documents, SMALL)
    rows = out.collect()
    assert rows
    if name != "sentencepiece":
        assert out.columns == odd_documents.columns
        given = {tuple(r) for r in odd_documents.collect()}
        assert all(tuple(r) in given for r in rows)
    assert stage(spark, no_documents, SMALL).count() == 0


def test_exact_groups_of_odd_rows(odd_documents):
    rows = exact_dedup.exact_groups(odd_documents).collect()
    # the longest original text keeps the group; blank, empty and null texts are equal
    assert {(r["group_size"], r["keep_id"]) for r in rows if r["group_size"] > 1} == {(5, 10), (4, 5)}
    assert sorted(r["doc_id"] for r in rows if r["kept"] and r["group_size"] > 1) == [5, 10]


def test_one_of_identical_rows_is_kept(spark):
    rows = exact_dedup.exact_groups(spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "ab")], "doc_id long, text string")).collect()
    assert [r["kept"] for r in rows].count(True) == 1 and {r["group_size"] for r in rows} == {3}


def test_both_dedups_keep_one_row_of_a_group(spark):
    a, b, c = "one text of a few words", "an entirely different passage about boats", "a third thing, of which one copy has no id"
    rows = [(1, a), (1, a), (2, a), (None, a), (None, b), (None, b), (None, "  " + c), (7, c), (7, b + " and much else that makes it longer than others")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    exact = [tuple(r) for r in exact_dedup.drop_exact_copies(docs).collect()]
    assert sorted(exact, key=str) == sorted([(1, a), (None, b), (None, "  " + c), rows[8]], key=str)
    assert len(exact) == exact_dedup.exact_groups(docs).where("kept").count()
    near = [tuple(r) for r in simhash.drop_near_copies(docs, distance=1).collect()]
    assert sorted(near, key=str) == sorted([(1, a), (None, b), (7, c), rows[8]], key=str)


def test_an_id_with_two_texts_loses_only_the_copy(spark):
    a, b = "one text of a few words", "an entirely different passage about boats"
    docs = spark.createDataFrame([(1, a), (2, a), (2, b), (3, b)], "doc_id long, text string")
    assert sorted(tuple(r) for r in simhash.drop_near_copies(docs, distance=1).collect()) == [(1, a), (2, b)]


def test_simhash_of_odd_rows(odd_documents):
    rows = simhash.near_duplicates(odd_documents).collect()
    blank = [r for r in rows if r["fingerprint"] == "0" * 16]
    assert len(blank) == 4 and {r["component_id"] for r in blank} == {3}


def test_only_null_ids(spark):
    rows = simhash.near_duplicates(spark.createDataFrame([(None, "a b c d e"), (None, "a b c d e")], "doc_id long, text string")).collect()
    assert [r["component_id"] for r in rows] == [None, None]


def test_line_report_of_odd_rows(spark):
    run = "\n".join(f"line {i} has just these seven words" for i in range(12))
    docs = spark.createDataFrame([(1, run), (2, "before\n" + run + "\nafter"), (None, run), (3, None), (4, ""), (5, run), (5, run)], "doc_id long, text string")
    found = {(r["doc_id"], r["n_lines"]): r["deleted"] for r in line_dedup.line_report(docs).collect()}
    assert found == {(1, 12): "", (2, 14): "1-12", (None, 12): "0-11", (3, 1): "", (4, 1): "", (5, 12): "0-11"}
    texts = {r["doc_id"]: r["text"] for r in line_dedup.drop_repeated_lines(docs).collect()}
    assert texts == {1: run, 2: "before\nafter", None: "", 3: None, 4: "", 5: ""}


def test_rows_that_share_an_id_or_have_none_keep_their_own_lines(spark):
    def lines(name, n=14):
        return "\n".join(f"{name} {i} has just these seven words" for i in range(n))

    run, rows = lines("line", 12), []
    for i in (None, 5):
        rows += [(i, lines(f"clean {i}")), (i, run), (i, f"before {i}\n" + run), (i, lines(f"other {i}") + "\n" + run)]
    docs = spark.createDataFrame([(1, run), *rows, *rows], "doc_id long, text string").repartition(4)
    found = {(r["doc_id"], r["text"]) for r in line_dedup.drop_repeated_lines(docs).collect()}
    expected = {(1, run)}
    for i in (None, 5):
        expected |= {(i, lines(f"clean {i}")), (i, ""), (i, f"before {i}"), (i, lines(f"other {i}"))}
    assert found == expected
    # a passage that only rows without an id hold stays in one of them
    passage = lines("said", 9)
    only = spark.createDataFrame([(None, passage + f"\nend {i}") for i in range(6)], "doc_id long, text string")
    counts = sorted((r["n_deleted"] for r in line_dedup.line_report(only).collect()))
    assert counts == [0, 9, 9, 9, 9, 9]


def test_leaks_of_odd_rows(spark, odd_documents, no_documents):
    items = spark.createDataFrame([(1, None), (2, ""), (None, "the same words in the same order stand here"), (3, "too short")], "item_id long, text string")
    found = decontam.find_leaks(odd_documents, items).collect()
    assert sorted(str(r["doc_id"]) for r in found) == ["1", "10", "2", "2", "None"] and {r["item_id"] for r in found} == {None}
    assert decontam.find_leaks(odd_documents, items.where("item_id = 99")).count() == 0
    assert decontam.find_leaks(no_documents, items).count() == 0


def test_toxicity_without_labels_or_documents(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(None, None), (1, None), (77, 1)], "doc_id long, toxic int")
    for docs in (odd_documents, no_documents):
        model = toxicity.fit(docs, labels)
        assert model.score("") < 0.5
    assert toxicity.fit(odd_documents, labels.where("doc_id = -5")).score("any") < 0.5


def test_langid_without_language(spark):
    docs = spark.createDataFrame([(1, "some text", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in langid.identify(docs, langid.learn(docs)).collect()} == {"und"}


def test_number_signs_are_no_letters(spark):
    docs = spark.createDataFrame([(1, "²½ ① Ⅷ ٣ 7 _"), (2, "xⅧ y²z"), (3, "ª ʰ Ǆ 漢 א")], "doc_id long, text string")
    rows = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs, {"en": b"x y z"}).collect()}
    assert rows == {1: "und", 2: "en", 3: "en"}
    assert langid.letters("xⅧ y²z ½") == b"x yz"


def test_every_language_is_learned_from_distinct_texts(spark):
    long = " ".join(f"wort{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(4000))
    copies = [(i, "the very same words again", "en") for i in range(2000)]
    others = [(3000 + i, f"text {chr(97 + i % 26)}{chr(97 + i // 26)}", "en") for i in range(500)]
    books = [(5000 + i, long + f" ende{chr(97 + i)}", "de") for i in range(10)]
    rare = [(10_000 + i * 5 + k, f"kind {chr(97 + i % 26)}", f"l{i}") for i in range(510) for k in range(5)]
    learned = langid.learn(spark.createDataFrame(copies + others + books + rare, "doc_id long, text string, lang string"))
    assert langid.letters(long)[:4] == b"wort" and 0 < len(learned["de"]) <= langid.DICTIONARY
    assert learned["en"].count(b"the very same words again") <= 1 and learned["en"].count(b"text") > 300
    assert len(learned) >= 505


def test_pipeline_on_its_tables(spark, tmp_path):
    out = corpus_pipeline.run(spark, SMALL)
    ids = [r["doc_id"] for r in out.select("doc_id").collect()]
    assert 0 < len(ids) < table(spark, SMALL, "documents").count() and len(set(ids)) == len(ids)
