"""Line deduplication over suffixes of line-id sequences.

Every document is a sequence of line ids. Prefix doubling names the suffixes: the name of order k
stands for the first 2^k lines of a suffix and is made of two names of order k - 1, so that any run
of m lines is named by two overlapping names. Suffixes with equal names form an interval of the
suffix array in which the longest common prefix has at least m lines; the first place of the
interval keeps its lines, and the run is deleted at the later ones.

A run counts when it has ``min_words`` words. It is enough to look at minimal runs: a line lies in a
repeated run of that size exactly if it lies in the minimal run that starts at some line, or ends the
minimal run that ends at it, and that minimal run stands at an earlier place too. Runs of equal lines
are as long wherever they stand, so both kinds are found by grouping names, and the union of what is
deleted is the union of the maximal repeated runs. As a line that counts has a word, a minimal
run has at most ``min_words`` lines, and six rounds of doubling are enough for 50 words.

DataFrame operations only; doubling works inside the rows, and only names travel.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerscope.llm.common import cut
from ledgerscope.llm.exact_dedup import WHITE

#: least words of a repeated run
MIN_WORDS = 50
#: places are ordered by id, text and line: the text's hash tells rows apart that share an id or have none
_LINES, _TEXTS = 1 << 31, 1 << 30
_LAST = Decimal(1 << 63)


#: the columns that name a row
ROW = ("id", "t1", "t2")


def _row_key(doc_id: str, text: str) -> list[Column]:
    """``id, t1, t2``: the id and two hashes of the text, which name a row; repeated rows have one name."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return [F.col(doc_id).alias("id"), F.xxhash64(whole).alias("t1"), F.xxhash64(F.lit(1), whole).alias("t2")]


def _row_order() -> Column:
    """Rows by id, then by a hash of their text; those without an id after all others, by a longer hash."""
    no_id = F.lit(_LAST) + F.shiftrightunsigned("t1", 2).cast("decimal(20,0)")
    first = F.coalesce(F.col("id").cast("decimal(20,0)"), no_id.cast("decimal(20,0)"))
    return (first * F.lit(_TEXTS) + F.shiftrightunsigned("t2", 34)).cast("decimal(30,0)")


def _lines(text: str) -> Column:
    """The lines of a text that have a word, as ``(one, two, words)``: two hashes of the line."""
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    trimmed = F.transform(lines, lambda x: F.btrim(x, F.lit(WHITE)))
    described = F.transform(
        trimmed,
        lambda x: F.struct(
            F.xxhash64(x).alias("one"),
            F.xxhash64(F.lit(1), x).alias("two"),
            F.when(x == "", 0).otherwise(F.regexp_count(x, F.lit("[ \t-\r]+")) + 1).alias("words"),
        ),
    )
    return F.filter(described, lambda x: x["words"] > 0)


def _name(names: str, at: Column) -> Column:
    return F.get(F.col(names), at)


def _doubled(docs: DataFrame, rounds: int) -> DataFrame:
    """Adds ``one0.. one<rounds>`` and ``two0..``: names of 2^k lines from every line on."""
    for side in ("one", "two"):
        docs = docs.withColumn(f"{side}0", F.col(f"lines.{side}"))
        for k in range(rounds):
            docs = docs.withColumn(f"{side}{k + 1}", F.transform(F.col(f"{side}{k}"), _pair(f"{side}{k}", 1 << k)))
    return docs


def _pair(names: str, step: int):
    """The next name of a place: of its name and the name ``step`` lines on, 0 past the end."""
    return lambda x, i: F.xxhash64(x, F.coalesce(_name(names, i + step), F.lit(0)))


def _run_name(side: str, start: Column, size: Column, rounds: int) -> Column:
    """Name of the ``size`` lines from ``start`` on: of its first and its last 2^k lines."""
    out = None
    for k in range(rounds, -1, -1):
        named = F.xxhash64(_name(f"{side}{k}", start), _name(f"{side}{k}", start + size - (1 << k)))
        out = named if out is None else F.when(size < (2 << k), named).otherwise(out)
    return out


def _minimal_runs(lines: DataFrame, min_words: int) -> DataFrame:
    """``id, t1, t2, kind, size, one, two, place, first, last``: minimal runs by start (0) and by end (1).

    ``place`` orders the runs of a name; ``first`` and ``last`` say which lines the run would delete, counted
    among the lines that have a word.
    """
    rounds = max(0, (min_words - 1).bit_length())
    docs = _doubled(lines, rounds)
    empty = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("size"))

    def reach(part: Column) -> Column:
        """Lines of ``part`` that it takes to gather the words, and the words gathered."""
        return F.aggregate(
            part,
            empty,
            lambda s, w: F.when(s["sum"] < min_words, F.struct((s["sum"] + w).alias("sum"), (s["size"] + 1).alias("size"))).otherwise(s),
        )

    words = F.col("lines.words")
    n = F.size("lines")
    forward = F.transform("lines", lambda x, i: reach(F.slice(words, i + 1, min_words)))
    back = F.transform("lines", lambda x, i: reach(F.reverse(F.slice(words, F.greatest(i + 2 - min_words, F.lit(1)), F.least(i + 1, F.lit(min_words))))))
    docs = docs.withColumn("n", n).withColumn("forward", forward).withColumn("back", back)

    def runs(reached: str, kind: int) -> Column:
        def described(r: Column, i: Column) -> Column:
            size = r["size"]
            start = i if kind == 0 else i - size + 1
            return F.struct(
                F.lit(kind).alias("kind"),
                size.alias("size"),
                _run_name("one", start, size, rounds).alias("one"),
                _run_name("two", start, size, rounds).alias("two"),
                start.alias("from"),
                i.alias("first"),
                (i + size - 1 if kind == 0 else i).alias("last"),
                (r["sum"] >= min_words).alias("whole"),
            )

        return F.filter(F.transform(F.col(reached), described), lambda x: x["whole"])

    docs = docs.withColumn("starts", runs("forward", 0)).withColumn("ends", runs("back", 1))
    each = docs.select(*ROW, F.explode(F.concat("starts", "ends")).alias("r"))
    return each.select(
        *ROW,
        *[F.col(f"r.{c}").alias(c) for c in ("kind", "size", "one", "two", "first", "last")],
        (_row_order() * F.lit(_LINES) + F.col("r.from")).cast("decimal(38,0)").alias("place"),
    )


def _repeated(docs: DataFrame, doc_id: str, text: str, min_words: int) -> DataFrame:
    """``id, t1, t2, at array<int>``: lines to delete in a row, counted among the lines that have a word."""
    lines = docs.select(*_row_key(doc_id, text), _lines(text).alias("lines"))
    runs = cut(_minimal_runs(lines, min_words))
    key = ["kind", "size", "one", "two"]
    kept = cut(
        runs.groupBy(*key)
        .agg(F.min("place").alias("kept"), F.max("place").alias("latest"))
        .where("kept <> latest")
        .select(*key, "kept")
    )
    later = runs.join(kept, key).where("place > kept")
    return cut(
        later.select(*ROW, F.explode(F.sequence("first", "last")).alias("line"))
        .groupBy(*ROW)
        .agg(F.array_sort(F.collect_set("line")).alias("at"))
    )


def _with_deleted(docs: DataFrame, doc_id: str, text: str, min_words: int) -> DataFrame:
    """``_llm_row, _llm_lines, _llm_deleted``: the row, all its lines, and the numbers (from 0) of those to delete."""
    gone = _repeated(docs, doc_id, text, min_words)
    rows = docs.select(F.struct("*").alias("_llm_row"), *_row_key(doc_id, text)).alias("d")
    same = F.col("d.id").eqNullSafe(gone["id"]) & (F.col("d.t1") == gone["t1"]) & (F.col("d.t2") == gone["t2"])
    joined = rows.join(gone, same, "left")
    lines = F.split(F.coalesce(F.col(f"_llm_row.`{text}`"), F.lit("")), "\n")
    worded = F.filter(F.transform(lines, lambda x, i: F.when(F.btrim(x, F.lit(WHITE)) != "", i)), lambda x: x.isNotNull())
    deleted = F.when(gone["at"].isNull(), F.array().cast("array<int>")).otherwise(F.transform(gone["at"], lambda at: F.get(worded, at)))
    return joined.select("_llm_row", lines.alias("_llm_lines"), deleted.alias("_llm_deleted"))


def line_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, n_lines, n_deleted, deleted``: one row per row; ``deleted`` lists runs of lines as first-last.

    A line is deleted if it lies in a run of lines that together have ``min_words`` words and that
    also stands at an earlier place: in a row with a smaller id, or earlier in the same one.
    Lines are compared without white space around them; lines without a word count for nothing, break
    no run and are never deleted. A row is known by its id and text: rows with both the same are one place, so a
    repeated row deletes nothing by itself; rows that share an id but not the text are places of their own, in
    the order of a hash of their texts, and so are rows without an id, which come last. Null and empty texts
    have one line, without a word; texts of any length are read whole; an empty table gives no rows. Lines are
    numbered from 0, runs of numbers follow each other comma-joined.
    """
    found = F.col("_llm_deleted")
    opens = F.array_except(found, F.transform(found, lambda x: x + 1))
    closes = F.array_except(found, F.transform(found, lambda x: x - 1))
    runs = F.zip_with(opens, closes, lambda a, b: F.concat_ws("-", a.cast("string"), b.cast("string")))
    return _with_deleted(docs.select(doc_id, text), doc_id, text, min_words).select(
        F.col(f"_llm_row.{doc_id}").alias("doc_id"),
        F.size("_llm_lines").cast("long").alias("n_lines"),
        F.size(found).cast("long").alias("n_deleted"),
        F.array_join(runs, ",").alias("deleted"),
    )


def drop_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the repeated lines (see ``line_report``) taken out of the texts; all rows and columns stay."""
    every = F.sequence(F.lit(0), F.size("_llm_lines") - 1)
    kept = F.transform(F.array_except(every, F.col("_llm_deleted")), lambda i: F.get(F.col("_llm_lines"), i))
    own = F.col(f"_llm_row.{text}")
    cleaned = F.when(F.size("_llm_deleted") == 0, own).otherwise(F.array_join(kept, "\n"))
    rows = _with_deleted(docs, doc_id, text, min_words)
    return rows.select(*[cleaned.alias(c) if c == text else F.col(f"_llm_row.`{c}`") for c in docs.columns])
