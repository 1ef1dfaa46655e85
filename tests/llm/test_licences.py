import textwrap

import pytest

from filmlake.llm import licences, queries

SF = "/root/testdata/sf0.01"

# The notices in the test tables.
NOTICES = {
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
    "This work is licensed under the GNU General Public License, version 3.": "GPL",
    "Licensed under the Apache License, Version 2.0.": "Apache",
    "Released under the MIT License.": "MIT",
    "All rights reserved.": "proprietary",
}


def test_every_notice_in_the_table(spark):
    got = {r.doc_id: r.families for r in queries.licence_scan(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        lower = r.text.lower()
        want = {family for notice, family in NOTICES.items() if notice.lower() in lower}
        assert got[r.doc_id] == ",".join(sorted(want))


def test_templates_variants_and_the_unknown_class(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = licences.fit(docs)
    for family, texts in licences.TEMPLATES.items():
        for text in texts:
            assert model.judge(licences.tokens(text))[0] == family
    assert model.judge(licences.tokens("this work is LICENSED under the gnu general public licence version 3"))[0] == "GPL"
    for text in ("the license plate was reserved", "my rights are public", "unseen words only", *licences.OTHERWISE):
        assert model.judge(licences.tokens(text))[0] == licences.UNKNOWN


def test_edges(spark):
    model = licences.fit_model([])
    long = "word " * 30_000 + "Released under the MIT License. " + "word " * 30_000
    docs = spark.createDataFrame(
        [(None, None, 1), (1, "", 1), (2, "x\nAll rights reserved.\n\nReleased under the MIT License.", 1), (3, long, 1)],
        "doc_id long, text string, notices int",
    )
    got = {r.doc_id: [(n.line, n.family) for n in r.notices] for r in licences.scan(docs, model).collect()}
    assert got == {None: [], 1: [], 2: [(1, "proprietary"), (3, "MIT")], 3: [(0, "MIT")]}
    assert licences.scan(docs.limit(0), model).count() == 0
    assert licences.fit(docs.limit(0)).families[-1] == licences.UNKNOWN


def test_several_notices_in_one_line():
    model = licences.fit_model([])
    mit, gpl = "Released under the MIT License. ", "This work is licensed under the GNU General Public License, version 3. "

    def found(text):
        return [(n[0], n[1], n[2]) for n in licences.notices(text, model)]

    assert found("word " * 300 + mit + "word " * 500 + gpl + "word " * 90) == [(0, 300, "MIT"), (0, 805, "GPL")]
    assert found("word " * 7 + mit + "word " * 60 + mit) == [(0, 7, "MIT"), (0, 72, "MIT")]
    assert found("x\n" + "word " * 15 + gpl + "word " * 15) == [(1, 15, "GPL")]
    assert [n[2] for n in found(mit + gpl)] == ["MIT", "GPL"]
    assert [n[2] for n in found(mit + "word " * 9 + gpl)] == ["MIT", "GPL"]
    for family, texts in licences.TEMPLATES.items():
        for text in texts:
            for before in (0, 3, 13, 19, 27, 39):
                assert [n[2] for n in found("word " * before + text + " word" * 45)] == [family]


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// ", ";; "])
@pytest.mark.parametrize("width", [20, 30, 40, 70, 100])
def test_a_wrapped_notice_is_one_notice(width, mark):
    model = licences.fit_model([])
    for family, texts in licences.TEMPLATES.items():
        for text in texts:
            lines = [mark + line for line in textwrap.wrap(text, width)]
            assert [n[:3] for n in licences.notices("\n".join(lines), model)] == [
                n[:3] for n in licences.notices(text, model)
            ]
            whole = "\n".join([f"{mark}word word word", mark, *lines, mark, f"{mark}more words"])
            assert [(n[0], n[2]) for n in licences.notices(whole, model)] == [(2, family)]


def test_notices_between_wrapped_lines():
    model = licences.fit_model([])

    def found(text):
        return [n[:3] for n in licences.notices(text, model)]

    prose = "word word word word word word\n"
    assert found("Licensed under\nthe MIT\nlicense.") == [(0, 0, "MIT")]
    assert found(prose * 9 + "Released under the MIT License.\n" + prose * 9) == [(9, 0, "MIT")]
    assert found(prose * 9 + "word Released under\nthe MIT License.\n" + prose * 9) == [(9, 1, "MIT")]
    two = "Released under the\nMIT License.\n" + prose * 12 + "Licensed under the Mozilla\nPublic License, version 2.0."
    assert found(two) == [(0, 0, "MIT"), (14, 0, "MPL")]
    assert found("Released under the MIT License.\n\nReleased under the MIT License.") == [(0, 0, "MIT"), (2, 0, "MIT")]
