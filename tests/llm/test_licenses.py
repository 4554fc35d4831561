from pyspark.sql import functions as F

from corpusloom.llm import licenses


def scan(spark, texts, known=None):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn(
        "digest", F.lit(1)).withColumn("_lines", F.lit(2))
    rows = sorted(licenses.license_scan(df, known=known).collect())
    return [(r.whole_license, r.n_notices, r.licenses) for r in rows]


def test_whole_texts_under_all_variations(spark):
    mit = licenses.MIT_BODY
    variants = [
        mit, "MIT License\n\nCopyright (c) 2021 Some One\n\n" + mit,
        "The MIT License (MIT)\nCopyright 1999-2003, A; B\nAll rights reserved.\n" + mit,
        mit.upper(), "  * " + mit.replace("\n", "\n  * "), mit.replace("\n", " "),
        mit.replace("sublicense", "sub-licence").replace('"', "“"),
        "© 2020 Me\n" + mit + "\n\n\n", mit.replace("WARRANTY", "WARANTY"), mit[:-10],
        "Prose first.\n" + mit]
    got = [w for w, _, _ in scan(spark, variants)]
    assert got == ["MIT"] * 8 + [None] * 3


def test_notices_in_documents(spark):
    got = scan(spark, [
        "Some prose.\nReleased under the MIT License.\nMore prose.",
        "LICENSED under CC-BY-NC 4.0!\nlicenced under the Apache Licence, version 2.0",
        "Released under the MIT License. With more on the line.",
        "Licensed under CC BY-NC 4.0.", None, "", " \n\n ", "no words: !!!\n???",
        "Released under the MIT License.\n" * 3, "x " * 100_000])
    assert got == [
        (None, 1, "MIT"), (None, 2, "Apache-2.0,CC-BY-NC-4.0"), (None, 0, ""),
        ("CC-BY-NC-4.0", 1, "CC-BY-NC-4.0"), (None, 0, ""), (None, 0, ""), (None, 0, ""),
        (None, 0, ""), (None, 1, "MIT"), (None, 0, "")]


def test_own_table_and_repeated_digests(spark):
    known = [("B", "Do what you like."), ("A", "do WHAT you like"), ("Z", "!!")]
    assert scan(spark, ["Do what you like", "other", "??"], known) == [
        ("A", 1, "A"), (None, 0, ""), (None, 0, "")]


def test_rows_stay_and_no_python(spark):
    df = spark.createDataFrame(
        [(1, "a"), (1, "a"), (None, "Released under the MIT License.")], "doc_id long, text string")
    out = licenses.license_scan(df)
    assert sorted((str(r.doc_id), r.n_notices) for r in out.collect()) == [
        ("1", 0), ("1", 0), ("None", 1)]
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapIn" not in plan
    assert licenses.license_scan(df.limit(0)).count() == 0


def test_full_texts(spark):
    texts = licenses.TEXTS
    assert sorted(texts) == ["Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GPL-2.0",
                             "GPL-3.0", "MPL-2.0", "Unlicense"]
    assert [w for w, _, _ in scan(spark, list(texts.values()))] == list(texts)
    flat = [t.upper() for t in texts.values()]
    assert [w for w, _, _ in scan(spark, flat)] == list(texts)
    filled = texts["Apache-2.0"].replace("[yyyy] [name of copyright owner]", "2020 Jane Doe")
    bsd = "BSD 3-Clause License\n\nCopyright (c) 2020, Me\nAll rights reserved.\n\n"
    head = "Copyright 2020 Jane Doe\n\n" + licenses.APACHE_HEADER
    got = scan(spark, [filled, filled[:filled.index("   APPENDIX")], head,
                       bsd + texts["BSD-3-Clause"], texts["GPL-3.0"][:-200]])
    assert [w for w, _, _ in got] == ["Apache-2.0"] * 3 + ["BSD-3-Clause", None]


def test_copyright_lines_by_name(spark):
    mit, isc = licenses.MIT_BODY, licenses.ISC_BODY
    lines = ["Copyright Jane Doe, 2020", "Copyright: 2020 X", "(c) Jane Doe 2020", "Copyright Jane",
             "Copyright <YEAR> <HOLDER>"]
    assert [w for w, _, _ in scan(spark, [f"{x}\n\n{mit}" for x in lines])] == ["MIT"] * 5
    # prose that begins with the word, and points of a list, stay
    prose = ["copyright notice and this", "COPYRIGHT NOTICE", "(c) You must retain it", "copyright 	x"]
    assert [w for w, _, _ in scan(spark, [f"{x}\n{mit}" for x in prose])] == [None] * 4
    assert [w for w, _, _ in scan(spark, [isc, isc.upper()])] == ["ISC"] * 2
