"""Rows that every operator must take: nulls in all columns, empty and long texts, ties, repeated rows, clashing names."""

import duckdb

from crawlmeta.llm.common import table

SF = "/root/testdata/sf0.001"
CLASHING = ("doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, "
            "keep_id long, h long, t string, label int, sequence_id long, range int, tail string, __score int, rep long, __h string, __keep int, __t_h string, __t_sha string, "
            "__drop long, __statistics string, __row string, __SHA int")
#: Values of the columns behind ``text``, which must come back as they are.
EXTRA = (0.5, False, 9, 8, "x", 1, 7, 6, "y", 5, 4, "h", 11, "th", "tsha", 12, "stat", "row", 13)
LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(30_000)) + ".\nThe end of it all."
PROSE = "the quick brown fox jumps over the lazy dog while seven wizards box on"


def rows():
    texts = [
        (1, PROSE, "en"), (2, PROSE, "en"), (3, PROSE.replace(" ", "\t \n"), "en"), (3, PROSE, "en"), (3, PROSE, "en"),
        (4, None, "en"), (5, "", "de"), (6, " \n\t ", None), (7, LONG, "en"), (8, LONG + " more", "en"),
        (9, "one", "de"), (10, "one two", "de"), (11, "1234 !!! ###", None), (12, "a  b   c ", "fr"),
        (None, PROSE, None), (None, None, None), (None, "ein anderer satz ohne nummer steht hier", "de"),
        (13, "日本語 の テキスト です 。 ﬁ é́ 😀", "ja"), (14, "<|endoftext|> <s> </s> ▁x", "en")]
    return [(i, t, g, "s", len(t or ""), *EXTRA) for i, t, g in texts]


def odd(spark):
    return spark.createDataFrame(rows(), CLASHING)


def empty(spark):
    return spark.createDataFrame([], CLASHING)


def documents(spark):
    return table(spark, SF, "documents")


def labels(spark):
    return table(spark, SF, "labels")


def texts():
    """(doc_id, text) of the small table, by id."""
    return duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet' order by doc_id").fetchall()
