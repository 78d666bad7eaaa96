import re

import pytest

from widetab.llm import licenses as L

from shared_fixtures import odd_docs, ready, sample_docs  # noqa: F401


@pytest.fixture(scope="module")
def model(spark):
    return L.train(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


CASES = [("Released under the MIT License.", "MIT"), ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
         ("This work is licensed under the GNU General Public License, version 3.", "GPL"), ("Licensed under CC BY-NC 4.0.", "CC-BY-NC"),
         ("Copyright 2020 Foo. Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
          "associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
          "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, subject to these conditions", "MIT"),
         ("Our files: licensed under CC BY-SA 4.0, as ever", "CC-BY-SA"), ("He lost his licence in the rain.", ""),
         ("The general public may visit.", ""), ("the and of to in", "")]


def test_families_and_plain_text(spark, model):
    docs = spark.createDataFrame([(i, f"first line of it\n{t}\nlast line") for i, (t, _) in enumerate(CASES)], "doc_id bigint, text string")
    got = {r.doc_id: r.families for r in L.scan(docs, model=model).collect()}
    assert [got[i] for i in range(len(CASES))] == [f for _, f in CASES]


def test_held_out_accuracy_and_unknown_names(spark, model):
    assert model.held_out_accuracy > 0.9
    docs = spark.createDataFrame([(1, "Licensed under the Zork License.")], "doc_id bigint, text string")
    r = L.scan(docs, model=model).first()
    assert (r.n_licence, r.families) == (0, "")


def test_sample_documents(spark, sample_docs, model):
    marks = (("MIT License", "MIT"), ("Apache License", "Apache-2.0"), ("General Public", "GPL"), ("CC BY-NC", "CC-BY-NC"))
    got = {r.doc_id: r.families for r in L.scan(sample_docs, model=model).collect()}
    for r in sample_docs.collect():
        assert got[r.doc_id] == ",".join(sorted({f for m, f in marks if m in r.text}))


def test_odd_rows_and_no_python(spark, odd_docs, model):
    got = L.scan(odd_docs, model=model)
    assert got.count() == odd_docs.count() and got.filter("families <> ''").count() == 0
    assert L.scan(odd_docs.limit(0), model=model).count() == 0
    assert not re.search("Python|Pandas|Arrow", got._jdf.queryExecution().executedPlan().toString())
    assert L.train(odd_docs.limit(0)).vocabulary                 # trains on its fixed part alone


NOTICES = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
           "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
           "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
           "Software is furnished to do so, subject to the following conditions:",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
           "conditions are met:",
    "Apache-2.0": "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                  "http://www.apache.org/licenses/LICENSE-2.0",
    "GPL": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
           "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."}


@pytest.mark.parametrize("mark", ["", "# ", " * "])
def test_wrapped_notices(spark, model, mark):
    import textwrap
    rows = []
    for i, (family, text) in enumerate(NOTICES.items()):
        wrapped = "\n".join(mark + x for x in textwrap.wrap(text, 72))
        rows.append((i, f"Some file of ours\n\n{wrapped}\n\nint main() {{ return 0; }}", family))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, family string")
    got = {r.doc_id: (r.families, r.n_licence) for r in L.scan(docs.union(docs), model=model).collect()}
    assert got == {i: (family, 1) for i, _, family in rows}


def test_a_row_and_its_copies_agree(spark, model):
    lines = [t for t, _ in CASES] + ["under the terms of a license", "the software is free", "Licensed under the Zork License."]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string")
    once = L.findings(docs, model).collect()
    twice = L.findings(docs.union(docs).union(docs), model).collect()
    near = lambda rows: sorted((r.k, r.place, r.family, round(r.probability, 9), round(r.similarity, 9)) for r in rows)
    assert near(once) == near(twice)


def test_scores_against_plain_python(spark, model, sample_docs):
    """Brute force of the line scores: distinct n-grams' weights, softmax, best template."""
    import math

    def grams(words, own):
        return {" ".join(words[i:i + k]) for k in (2, 3) for i in range(min(own, len(words) - k + 1))}

    def words(t):
        return [w for w in re.split("[^a-z0-9]+", t.lower()) if w]
    where = {g: i for i, g in enumerate(model.vocabulary)}
    known = [(f, grams(words(t), 10 ** 6)) for f, t in L.templates()]
    docs = sample_docs.limit(60)
    got = {(r.k, r.place): r for r in L.findings(docs, model).collect()}
    seen = 0
    for r in docs.collect():
        ls = (r.text or "").split("\n")
        for i, line in enumerate(ls):
            own = words(line)
            found = grams(own + (words(ls[i + 1])[:2] if i + 1 < len(ls) else []), len(own))
            z = [b + sum(model.weights[c][where[g]] for g in found if g in where) for c, b in enumerate(model.bias)]
            z = [v / model.temperature for v in z]
            c = max(range(len(z)), key=lambda j: z[j])
            if model.classes[c] == "none" or not found & (set(where) | set().union(*[g for _, g in known])):
                continue
            p = 1 / sum(math.exp(v - z[c]) for v in z)
            best = max([0.0, *[len(found & g) / len(g) for f, g in known if f == model.classes[c] and g]])
            sure = model.classes[c] != "unknown" and p >= model.least and best >= L.CONFIRM
            x = got[r.doc_id, i]
            assert x.family == (model.classes[c] if sure else "unknown") and abs(x.probability - p) < 1e-6 and abs(x.similarity - best) < 1e-9
            seen += 1
    assert seen


def test_negatives_are_the_smallest_hashes(spark):
    docs = spark.createDataFrame([(i, "\n".join(f"line {j} of text" for j in range(i, i + 6))) for i in range(300)], "doc_id bigint, text string")
    got = [r.line for r in L._plain_lines(docs, "doc_id", "text", 50, 5).collect()]
    assert len(got) == len(set(got)) == 50
    assert [r.line for r in L._plain_lines(docs.repartition(9), "doc_id", "text", 50, 5).collect()] == got
    assert L._plain_lines(docs, "doc_id", "text", 1000, 5).count() == 305
