"""Licence scan: held-out accuracy on generated paragraphs, and planted lines."""

import random
import textwrap

import numpy as np
import pytest
from pyspark.sql import functions as F

from vaultmart.llm import license_scan as ls


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def model(docs):
    return ls.train(docs)


def test_common_subsequence():
    assert ls.common_subsequence("a b c d".split(), "x a c y d".split()) == 3
    assert ls.common_subsequence(["a"], []) == 0 and ls.common_subsequence(["a", "a"], ["a"]) == 1


def test_held_out_accuracy(model):
    rng = random.Random(77)  # other noise than the training's
    right = total = 0
    for family, text in ls.TEMPLATES:
        for k in range(20):
            words = text.split()
            if k % 2 and len(words) > 8:
                words.pop(next(i for i in rng.sample(range(len(words)), len(words))
                               if not ls.VARIANT.search(words[i].lower())))
            if k % 3 == 1:
                words = [f"zz{rng.randrange(99)}" for _ in range(3)] + words
            paragraph = " ".join(words)
            found = model.classify([paragraph.upper() if k % 5 == 0 else paragraph])[0]
            total += 1
            right += found is not None and found[0] == family
    assert right / total >= 0.9


def test_unknown_stays_unknown(model, docs):
    lines = [x for d in docs.collect() for x in (d.text or "").split("\n")]
    clean = [x for x in lines if "icense" not in x]
    assert len(clean) > 300 and not any(model.classify(clean))
    near = ["the license of the work", "version 3 of the text", "under the terms", "Copyright", "CC", "MIT",
            "public domain by 4.0", "licensed"]
    assert not any(model.classify(near))


def test_variants_are_told_apart(model):
    found = model.classify(["Licensed under CC BY 4.0.", "Licensed under CC BY-NC 4.0.", "Licensed under CC BY-SA 4.0.",
                            "This work is licensed under the GNU General Public License, version 3."])
    assert [f and f[0] for f in found] == ["CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "GPL-3.0"]


def test_witnesses_lose_nothing(model):
    rng = random.Random(1)
    for family, text in ls.TEMPLATES:
        for _ in range(30):
            words = [w for w in text.split() if rng.random() > 0.15]
            if model.matches(ls.normal_words(" ".join(words))):
                assert model.may_agree(" ".join(words))


def test_tables(spark, model):
    mit = "Released under the MIT License."
    rows = [(0, None), (1, ""), (2, " \n "), (3, "text\n" + mit + "\nmore"), (4, mit + "\n" + mit), (5, "x " * 50_000 + mit),
            (6, "plain text"), (3, "text\n" + mit + "\nmore")]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, family string")
    got = docs.select("doc_id", F.explode(ls.scan(F.col("text"), model)).alias("f")).select("doc_id", "f.*").collect()
    assert sorted((r.doc_id, r.paragraph, r.family) for r in got if r.doc_id != 5) == [
        (3, 1, "MIT"), (3, 1, "MIT"), (4, 0, "MIT"), (4, 1, "MIT")]
    assert docs.limit(0).select(ls.scan(F.col("text"), model)).count() == 0
    assert not any(ls.train(docs.limit(0)).classify(["plain text"]))


def test_whole_table(spark, docs):
    from vaultmart.llm.queries import op2_license_scan
    planted = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT",
               "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
               "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0"}
    want = sorted((d.doc_id, k, planted[x]) for d in docs.collect() for k, x in enumerate((d.text or "").split("\n")) if x in planted)
    got = op2_license_scan(spark, "/root/testdata/sf0.001").collect()
    assert sorted((r.doc_id, r.paragraph, r.family) for r in got) == want and want


NOTICES = {
    "MIT": ls.TEMPLATES[3][1], "BSD-3-Clause": ls.TEMPLATES[8][1],
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
               "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
               "option) any later version.",
    "MPL-2.0": ls.TEMPLATES[10][1], "Apache-2.0": ls.TEMPLATES[1][1]}


@pytest.mark.parametrize("lead", ["", " * ", "# "])
@pytest.mark.parametrize("width", [30, 72])
def test_wrapped_notices(model, lead, width):
    for family, notice in NOTICES.items():
        lines = textwrap.wrap(notice, width)
        text = "\n".join(["some text before", *(lead + x for x in lines), lead.rstrip(), "and text after it"])
        found = model.find(text)
        assert [(f["family"], f["paragraph"], f["last_line"]) for f in found] == [(family, 1, len(lines))]
        assert ls.normal_words(text[found[0]["start"]:found[0]["end"]]) == ls.normal_words(notice)


def test_blank_lines_part_notices(model):
    lines = textwrap.wrap(NOTICES["MIT"], 72)
    assert model.find("\n".join(lines)) and not model.find("\n \n".join(lines))


def test_notice_inside_a_long_line(spark, model):
    mit = "Released under the MIT License."
    docs = spark.createDataFrame([(5, "x " * 50_000 + mit), (6, "x " * 20_000 + mit + " y" * 20_000 + " " + mit)],
                                 "doc_id long, text string")
    got = docs.select("doc_id", "text", F.explode(ls.scan(F.col("text"), model)).alias("f")).select(
        "doc_id", "f.paragraph", "f.start", "f.family", F.expr("substring(text, f.start + 1, f.end - f.start)").alias("span"))
    end = 40_000 + len(mit) + 40_001
    assert sorted(tuple(r) for r in got.collect()) == [
        (5, 0, 100_000, "MIT", mit[:-1]), (6, 0, 40_000, "MIT", mit[:-1]), (6, 0, end, "MIT", mit[:-1])]


def test_windows_against_every_offset(model):
    """The bound and the starts at template words lose no window."""
    rng = random.Random(3)
    agreeing = 0
    for trial in range(60):
        family, text = ls.TEMPLATES[trial % len(ls.TEMPLATES)]
        words = [w for w in ls.normal_words(text) if rng.random() > 0.1]
        for _ in range(rng.randint(0, 6)):
            words.insert(rng.randint(0, len(words)), rng.choice(["zz", "the", "license", "under"]))
        words = ["yy"] * rng.randint(0, 9) + words + ["yy"] * rng.randint(0, 9)
        got = {k for k, _, _, _ in model.windows(np.array([model.terms.get(w, -1) for w in words]))}
        want = set()
        for k, (f, template) in enumerate(model.templates):
            size = len(template) + max(ls.SLACK, len(template) // 4)
            for a in range(len(words)):
                part = words[a:a + size]
                if (ls.common_subsequence(template, part) >= ls.AGREE * len(template) - 1e-9
                        and all(w in part for w in template if ls.VARIANT.fullmatch(w))):
                    want.add(k)
        assert got == want
        agreeing += bool(want)
    assert agreeing > 30


def test_lines_with_many_words_put_in_are_still_found(model):
    """What the line alone confirms stays found, though no window is that long."""
    words = NOTICES["MIT"].split()
    line = " ".join(w + (" zz" if k % 2 else "") for k, w in enumerate(words))
    assert model.classify([line])[0] is None or [f["family"] for f in model.find(line)] == ["MIT"]


HEADER = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public "
          "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.")


def test_near_families_are_told_apart(model):
    families = lambda text: [f["family"] for f in model.find(text)]
    assert families(HEADER.format("")) == ["GPL-3.0"]
    assert families(HEADER.format("Affero ")) == ["AGPL-3.0"]
    assert families(HEADER.format("Lesser ").replace("program", "library")) == ["LGPL-3.0"]
    assert families("Distributed under the Boost Software License, Version 1.0.") == ["BSL-1.0"]
    assert families("Released under the ISC License.") == ["ISC"]
    for name, family in (("MIT", "MIT"), ("AGPL-3.0-only", "AGPL-3.0"), ("GPL-2.0-only", "GPL-2.0"), ("ISC", "ISC"), ("BSL-1.0", "BSL-1.0")):
        assert families(f"// SPDX-License-Identifier: {name}") == [family]
    assert families("// SPDX-License-Identifier: Sleepycat") == []
    assert families("\n".join(textwrap.wrap(HEADER.format("Affero "), 60))) == ["AGPL-3.0"]


def test_the_classifier_decides(model, monkeypatch):
    """Paragraphs that agree with a template, and that only the model rejects."""
    near = ["This work is licensed under the GNU Free Documentation License, version 3.",
            "This work is licensed under the GNU Free Documentation License, version 3, by its authors."]
    agreeing = [x for x in near if model.matches(ls.normal_words(x))]
    assert agreeing and not any(model.find(x) for x in near)
    sure = lambda x: np.eye(len(model.families))[np.full(len(x), model.families.index("GPL-3.0"))]
    monkeypatch.setattr(model, "probabilities", sure)
    assert any(model.find(x) for x in agreeing)  # without its judgement they would be found
