import re
import textwrap

from compare import DATA, of_spark, of_sql

from fernweave.llm import license_scan as L

MORE = [
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "permission hereby granted free of charge to any person obtaining a copy of this software and associated documentation",  # two words short
    "x y\nLicensed under the Apache License, Version 2.0 (the License)\nz",
    "Licensed under the Apache\nLicense, Version 2.0",  # hard-wrapped
    "Licensed under the Apache\n\nLicense, Version 2.0",  # parted over two paragraphs
    "cc by, cc by; cc  by",
    "general public license general public license all rights reserved",
    "GENERAL PUBLIC LICENSE\u00a0x K\u212a cc by",
    "Licensed under CC BY-NC 4.0. Released under the MIT License.",
    "accc by cc byte",
]


def test_edges_equal_sql(spark, folder, odd_documents):
    at = folder(documents=odd_documents + [(100 + i, t) for i, t in enumerate(MORE)])
    got = L.op8_license_scan(spark, at)
    assert of_spark(got) == of_sql(L.ORACLE, at)
    labels = {r["doc_id"]: r["labels"] for r in got.collect()}
    assert labels[100] == "mit" and labels[101] == "" and labels[102] == labels[103] == "apache-2.0" and labels[104] == ""
    assert labels[108] == "cc-by,cc-by-nc,mit"


def test_single_lines(spark):
    """Without ``wrapped`` a block is a line."""
    df = spark.createDataFrame([(0, MORE[2]), (1, MORE[3])], "k int, text string")
    assert [r["labels"] for r in L.scan_licenses(df, wrapped=False).orderBy("k").collect()] == ["apache-2.0", ""]


def test_query_equals_sql(spark):
    assert of_spark(L.op8_license_scan(spark, DATA)) == of_sql(L.ORACLE)


def test_no_python_on_the_executors(spark):
    plan = L.op8_license_scan(spark, DATA)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "ExternalRDD"))


def test_every_template_is_found_by_its_own_words(spark):
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(L.TEMPLATES)], "k int, text string")
    out = L.scan_licenses(df).orderBy("k").collect()
    assert all(label in r["labels"].split(",") for r, (label, _) in zip(out, L.TEMPLATES, strict=True))


def test_empty_table(spark, folder):
    assert L.op8_license_scan(spark, folder(documents=[])).count() == 0


def in_wrapped_lines(text):
    """Labels and the best share by a plain look at each line and the words behind it in its paragraph."""
    most, out = max(len(re.findall("[a-z0-9]+", t.lower())) for _, t in L.TEMPLATES), {}
    lines = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", line.translate(str.maketrans(L.UPPER, L.LOWER))) for line in (text or "").split("\n")]
    for i, line in enumerate(lines):
        end = next((j for j in range(i, len(lines)) if not lines[j]), len(lines))
        own = set(line) | set([w for x in lines[i + 1 : end] for w in x][:most])
        for label, t in L.TEMPLATES:
            share = len(own & set(L.words(t))) / len(L.words(t))
            if share >= L.THRESHOLD:
                out[label] = max(share, out.get(label, 0))
    return set(out), max(out.values(), default=0.0)


def test_wrapped_notices_are_found(spark, folder, odd_documents):
    texts = ["x\n" + " * " + textwrap.fill(t, width, break_long_words=False, break_on_hyphens=False).replace("\n", "\n * ") + " and more\ny" for _, t in L.TEMPLATES for width in (12, 30, 72)]
    rows = odd_documents + [(100 + i, t) for i, t in enumerate(MORE + texts)]
    got = {r["doc_id"]: r for r in L.op8_license_scan(spark, folder(documents=rows)).collect() if r["doc_id"]}
    for i, (label, _) in enumerate((t for t in L.TEMPLATES for _ in range(3)), 100 + len(MORE)):
        assert label in got[i]["labels"].split(",")
    for k, t, *_ in rows:
        if k and k != 4:
            labels, score = in_wrapped_lines(t)
            base = set(filter(None, got[k]["base_labels"].split(",")))
            assert set(filter(None, got[k]["labels"].split(","))) == labels | base and got[k]["score"] == (1 if base else score)


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "cc by", 5, "x", "y")], "k int, text string, n_words int, labels string, __met string")
    out = L.scan_licenses(df)
    assert sorted(out.columns) == sorted(["k", "text", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])
    assert out.first()["labels"] == "cc-by" and out.first()["n_words"] == 2
