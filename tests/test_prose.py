import html
import random
import re

import pytest
from pyspark.sql import functions as F

from sheetflow.functions import institutions as inst
from sheetflow.functions import prose
from sheetflow.functions.strings import running_sums


def expected_sentences(text):
    found, at = [], 0
    for piece in re.split(r"(\n\s*\n)", text):
        last = 0
        ends = [m.end() for m in re.finditer(prose.SENTENCE_END, piece)] + [len(piece)]
        for end in ends:
            raw = piece[last:end]
            if len(raw.strip()) > 10:
                found.append((raw.strip(), at + last + len(raw) - len(raw.lstrip())))
            last = end
        at += len(piece)
    return found


TEXT = "Dr. Smith went home today. Then he slept! Was it U.S. property?  Yes it was. ok.\n \n\n  第一句话在这里结束了。 第二句话也在这里结束了！ \n\nshort\n\nAbc. Lower case goes on without end"


def test_sentences(one):
    got = [(s["sentence"], s["pos"]) for s in one(prose.split_sentences(F.lit(TEXT)))]
    assert got == expected_sentences(TEXT) and len(got) > 4
    assert all(TEXT[p : p + len(s)] == s for s, p in got)
    assert one(prose.split_sentences(F.lit(None).cast("string"))) is None
    assert one(prose.split_sentences(F.lit(""))) == []


def test_sentences_of_any_text(spark):
    """Against the plain walk over the text, also with odd blanks, astral characters and the marks used inside."""
    rng = random.Random(11)
    bits = ["Abc", "word", " ", "  ", ". ", ".", "! ", "？", "。\u3000", "\n", "\n\n", "\n \t\n", "\x1c", "\xa0", "\x85", "\u2028", "\U0001f600", "\uffff", "\ufffe", "é", "Xyz. ", "Q. A", "\r\n", "longer words here"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(60))) for _ in range(600)] + ["Many a sentence. " * 3000, "\n\n" * 500, "x" * 50_000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", prose.split_sentences("t").alias("s"))
    for r in df.collect():
        assert [(s["sentence"], s["pos"]) for s in r["s"]] == expected_sentences(texts[r["i"]]), texts[r["i"]]


@pytest.mark.parametrize("values", [[], [5], [1, 2], [3, 0, 4, 1], list(range(64)), list(range(65)), list(range(10_000))])
def test_running_sums(one, values):
    given = F.from_json(F.lit(str(values)), "array<int>")
    assert one(running_sums(given)) == [sum(values[:i]) for i in range(len(values))]


def test_html(one):
    page = "<html><head><title>T&amp;x</title><style>p{}</style><SCRIPT>var t='</p>'</SCRIPT></head><body><!-- <p>no</p> --><p>One <b>two</b>&copy; 1 < 2 &lt;b&gt;\n\nx</p><p>Three&nbsp;four</p></body>"
    assert one(prose.html_to_text(F.lit(page))) == "T&x One two © 1 < 2 <b> x Three four"
    assert one(prose.html_to_text(F.lit(page), paragraphs=True)) == "T&x\n\nOne two © 1 < 2 <b> x\n\nThree four"
    assert one(prose.html_to_text(F.lit(None).cast("string"))) is None


REFERENCES = ["&amp;", "&amp", "&notit;", "&#65;", "&#x41", "&#X1F600;", "&#0;", "&#00000000000000000000000000000000000000065;", "&", "&&", "&;", "&#;", "&#x;", "&unknown;", "&CounterClockwiseContourIntegral;", "&lt;b&gt;", "&é;", "&😀copy;", "&nbsp", "&amp;lt;", "&" + "x" * 40 + ";"]


def test_character_references(spark):
    rng = random.Random(5)
    bits = [*REFERENCES, "word", " ", "\n", "\t", ";", "#", "é", "😀", "$1", "\\"]
    texts = ["", *REFERENCES, *("".join(rng.choice(bits) for _ in range(rng.randrange(30))) for _ in range(500)), "a&lt;" * 20_000, None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", prose.unescape_entities("t").alias("u"))
    for r in df.collect():
        assert r["u"] == (None if texts[r["i"]] is None else html.unescape(texts[r["i"]])), texts[r["i"]]


@pytest.mark.parametrize("given", [{}, {"paragraphs": True}, {"marks": True}])
def test_no_page_text_goes_to_python(spark, given, monkeypatch):
    """A worker holds whole batches, so it is only given what it needs: distinct references, not the texts."""
    sent = []
    resolve = prose.resolve_references

    def seen(c):
        sent.append(c)
        return resolve(c)

    monkeypatch.setattr(prose, "resolve_references", seen)
    page = "<p>" + "long text " * 1000 + "&amp;&copy;&amp;</p>"
    df = spark.createDataFrame([(page,)], "html string")
    assert df.select(prose.html_to_text("html", **given).alias("t")).collect()[0]["t"].endswith("long text &©&")
    assert [r[0] for c in sent for r in df.select(c).collect()] == [["&amp;", "&copy;"]]


def test_marks_of_lists_and_headings(one):
    page = "<body><h1>Top</h1>\n<H3 id='a>b'>Sub</H3><ul><li>one</li><li class=x>two <b>bold</b></ul>text<header>no heading</header><link rel=x><hr></body>"
    assert one(prose.html_to_text(F.lit(page), marks=True)) == "# Top\n\n### Sub\n\n- one\n\n- two bold\n\ntext\n\nno heading"
    assert [one(prose.is_noise(F.lit(line))) for line in ("- one", "## Sub head", "# Top")] == [True, True, False]


def test_markdown(one):
    text = "**Bold** and *it* [link](http://x) `code` <b>t</b>"
    assert one(prose.clean_markdown(F.lit(text))) == "Bold and it link code t"
    assert one(prose.markdown_to_plain(F.lit("a\n\n  **b**\tc "))) == "a b c"


@pytest.mark.parametrize(
    "text, noise",
    [("- list item here", True), ("12. numbered", True), ("## head line", True), ("Browse all", True), ("see a.png) here", True), ("a + b + c + d + e", True), ("a + b + c + d", False), ("Plain words", False), ("5.5 is fine", False)],
)
def test_noise(one, text, noise):
    assert one(prose.is_noise(F.lit(text))) is noise


def test_usable(one):
    for size, ok in ((10, False), (11, True), (800, True), (801, False)):
        assert one(prose.usable_sentence(F.lit("x" * size))) is ok


def test_phrases(one):
    assert one(prose.first_phrase(F.lit("It is KNOWN"), inst.KEY_PHRASES)) == "own"
    assert one(prose.first_phrase(F.lit("It is KNOWN"), inst.KEY_PHRASES, whole_word=True)) is None
    assert one(prose.first_phrase(F.lit("Copyright © x, edited"), inst.KEY_PHRASES)) == "edited"
    assert one(prose.first_phrase(F.lit("Copyright © x"), inst.KEY_PHRASES)) == "copyright ©"


@pytest.mark.parametrize(
    "name, kind, clean",
    [
        ("© 1999-2025 Maker & Sons, Inc or related companies", "copyright", "Maker & Sons, Inc or related companies"),
        ("Maker & Sons, Inc or related companies", "publisher", "Maker & Sons, Inc"),
        ("published by the North Press, 2020", "host", "North Press"),
        ("The North, Society;", "host", "The North Society"),
        ("Connect with us", "host", ""),
        ("**Bold** Group", "host", "Bold Group"),
    ],
)
def test_clean_name(one, name, kind, clean):
    assert one(inst.clean_institution(F.lit(name), kind)) == clean


def test_kind(one):
    for sentence, kind in (("© x press", "copyright"), ("x press society", "publisher"), ("the society", "host"), ("nothing", "host")):
        assert one(inst.institution_type(F.lit(sentence), F.lit("n"))) == kind


@pytest.mark.parametrize(
    "text, names",
    [
        ("© NACI and North Wind and Sons A/S. Published by North Wind and Sons, Ltd", ["NACI and North Wind and Sons A/S", "North Wind and Sons, Ltd"]),
        ("Copyright © 1999-2025 North Wind & Sons, Inc or related companies.", ["North Wind & Sons, Inc or related companies"]),
        ("Allergy, the official journal of the European Academy of Sneezing (EAS), aims to advance research.", ["European Academy of Sneezing"]),
        ("Browse the journal of the Noise Society here.", []),
        ("No organisation is named in this line.", []),
        (None, []),
    ],
)
def test_extract(one, text, names):
    found = one(inst.extract_institutions(F.lit(text).cast("string")))
    assert [i["name"] for i in found] == names
    for i in found:
        assert i["extraction_method"] == "regexp" and text[i["char_position"]["start"] : i["char_position"]["end"]] == i["source_sentence"]


def test_contained_names(one):
    items = F.from_json(F.lit('[{"name":"North Press"},{"name":"north"},{"name":"The North Press Group"},{"name":"South"}]'), f"array<{inst.INSTITUTION}>")
    assert [i["name"] for i in one(inst.dedupe_contained(items))] == ["North Press", "South"]


def test_model_first(one):
    rules, none = F.array(F.lit("r")), F.array().cast("array<string>")
    assert tuple(one(inst.extract_auto(F.array(F.lit("m")), rules))) == (["m"], "langextract")
    assert tuple(one(inst.extract_auto(none, rules))) == (["r"], "regexp")
    assert tuple(one(inst.extract_auto(F.lit(None).cast("array<string>"), rules))) == (["r"], "regexp")
