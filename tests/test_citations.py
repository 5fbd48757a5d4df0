"""Citations: sentences composed from units, numbers and gaps, whose meaning follows from what they were composed of, and hard cases."""

import itertools
import random

import pytest

from lexgrid.operators.citations import GENERAL, ORDINALS, SPECIAL, ExtractCitations, citations, expand, extract, roman, target_doc

CODE, ALIAS, OWN = ("Fuqarolik kodeksining", {}), ("FKning", {"allow_fk_alias": True}), ("mazkur Kodeksning", {"is_the_code": True})
NAMES = {"Fuqarolik kodeksining": "fuqarolik_kodeksi", "FKning": "fk_alias", "mazkur Kodeksning": "self_reference"}
FILLERS = ("Ijarachi bu holda", "Sud qarori asosida", "Tomonlar kelishuviga koʻra")
ENDS = (" qoʻllanadi.", " boʻyicha hal etiladi;", "")


def numerals(n):
    """Greedy Roman numerals, by a table of values."""
    out = ""
    for value, letters in ((50, "L"), (40, "XL"), (10, "X"), (9, "IX"), (5, "V"), (4, "IV"), (1, "I")):
        while n >= value:
            out, n = out + letters, n - value
    return out


def listed(rng):
    """(as written, the numbers, what kind of list): single numbers, lists of either conjunction, one span, lists with spans."""
    kind = rng.choice(("single", "list", "range", "mixed", "falling"))
    first = rng.randint(2, 330)
    if kind == "single":
        return str(first), [first], "single"
    if kind == "range":
        last = first + rng.randint(1, 30)
        return f"{first}{rng.choice(('-', ' — ', ' – ', '–'))}{last}", list(range(first, last + 1)), "range"
    if kind == "falling":  # its two ends are named, nothing between them
        return f"{first + 9}-{first}", [first + 9, first], "list"
    steps = [first + 3 * k for k in range(rng.randint(2, 4))]
    parts, numbers = [str(x) for x in steps], list(steps)
    if kind == "mixed":
        parts.insert(1, f"{first + 100}-{first + 102}")
        numbers[1:1] = range(first + 100, first + 103)
    return ", ".join(parts[:-1]) + rng.choice((" va ", " hamda ", ", ")) + parts[-1], numbers, "list"


@pytest.mark.parametrize("anchor, given", [CODE, ALIAS, OWN])
@pytest.mark.parametrize("seed", range(6))
def test_lists_of_articles(anchor, given, seed):
    rng = random.Random(f"{anchor}{seed}")
    for _ in range(20):
        written, numbers, listing = listed(rng)
        gap, many = rng.choice(("-", " - ", " ")), "lari" if len(numbers) > 1 else "si"
        head = rng.choice(FILLERS) + " "
        text = f"{head}{anchor} {written}{gap}modda{many}{rng.choice(ENDS)}"
        found = extract(text, **given)
        assert [(c.target_kind, c.article, c.listing, c.qism) for c in found] == [("article", str(n), listing, None) for n in numbers], text
        assert {c.anchor for c in found} == {NAMES[anchor]} and all(text[c.start : c.end].startswith(written[:3]) for c in found)
        assert all(c.evidence == " ".join(c.evidence.split()) and written.split(",")[0].split()[0] in c.evidence for c in found)
        assert expand(written) == ([str(n) for n in numbers], listing)


@pytest.mark.parametrize("unit", ["qism", "band"])
@pytest.mark.parametrize("ending", ["si", "sining"])
def test_units_of_an_article(unit, ending):
    for k, word in enumerate(ORDINALS[:9]):
        for apostrophe in "ʻ'ʼ":
            said = word.replace("ʻ", apostrophe)
            text = f"Fuqarolik kodeksining {100 + k}-modda{ending} {said} {unit}iga binoan"
            assert [(c.article, c.qism) for c in extract(text)] == [(str(100 + k), f"{said} {unit}")], text
    assert [c.qism for c in extract(f"Fuqarolik kodeksining 8-modda{ending} 4-{unit}i")] == [f"4-{unit}"]


@pytest.mark.parametrize("low, high", itertools.combinations(range(6), 2))
def test_spans_and_lists_of_units(low, high):
    span = f"mazkur Kodeksning 70-moddasining {ORDINALS[low]} — {ORDINALS[high]} qismlari"
    assert [c.qism for c in extract(span, is_the_code=True)] == [f"{ORDINALS[k]} qism" for k in range(low, high + 1)]
    pair = f"mazkur Kodeksning 70-moddasi {ORDINALS[low]}, {ORDINALS[high]} qismlarida"
    assert [c.qism for c in extract(pair, is_the_code=True)] == [f"{ORDINALS[k]} qism" for k in (low, high)]


def test_a_unit_is_its_own_articles():
    """A unit goes to each article of a genitive list, to the last item of others, and never over a comma or another act."""
    assert [(c.article, c.qism) for c in extract("Fuqarolik kodeksining 6, 7-moddalarining birinchi qismi")] == [("6", None), ("7", None)]
    assert [(c.article, c.qism) for c in extract("Fuqarolik kodeksining 6-moddasi, 7-moddasi ikkinchi qismi")] == [("6", None), ("7", "ikkinchi qism")]
    assert [c.qism for c in extract("Fuqarolik kodeksining 6-moddasi, UJKning 9-moddasi ikkinchi qismi")] == [None]
    assert [c.qism for c in extract("Fuqarolik kodeksining 6-moddasi " + "soʻz " * 20 + "ikkinchi qismi")] == [None]


@pytest.mark.parametrize("n", [1, 4, 9, 14, 19, 28])
@pytest.mark.parametrize("section", [None, 1, 6])
def test_chapters_parts_and_sections(n, section):
    tails = {"": None} if section is None else {f"ning {section}-paragrafi": section, f", {section} paragrafi": section, f" § {section}": section}
    for tail, s in tails.items():
        for chapter in (f"{n}-bobi", f"{numerals(n)} bobi"):
            found = extract(f"Fuqarolik kodeksining {chapter}{tail}da nazarda tutilgan")
            assert [(c.target_kind, c.struct_number, c.section_number) for c in found] == [("chapter" if s is None else "section", n, s)], chapter + tail
    assert [(c.target_kind, c.struct_number) for c in extract(f"Fuqarolik kodeksining {numerals(n)} boʻlimi")] == [("part", n)]
    assert [(c.target_kind, c.struct_number) for c in extract(f"Fuqarolik kodeksining {n}-boʻlimi")] == [("chapter", n)]
    assert roman(numerals(n)) == n


@pytest.mark.parametrize("between", ["“Ijara toʻgʻrisida”gi Qonunning ", "Mehnat kodeksining ", "Prezident Farmonining ", "UJKning ", "Nizomning ", "Konstitutsiyaning "])
def test_another_act_ends_the_window(between):
    assert [c.article for c in extract(f"Fuqarolik kodeksining 12-moddasi, {between}34-moddasi")] == ["12"]
    assert [(c.target_kind, c.article) for c in extract(f"Fuqarolik kodeksi va {between}34-moddasi")] == [("act", None)]


def test_windows_end():
    """At the next anchor, and some 260 characters on."""
    text = "Fuqarolik kodeksining 5-moddasi. " + "Fuqarolik kodeksining 6-moddasi"
    first, second = extract(text)
    assert (first.article, second.article) == ("5", "6") and second.start > text.rindex("kodeksining")
    assert [c.article for c in extract("Fuqarolik kodeksining 5-moddasi" + " soʻz" * 60 + " 6-moddasi")] == ["5"]


def test_what_is_no_anchor():
    for text, given in (
        ("Fuqarolik protsessual kodeksining 4-moddasi", {}), ("1964-yilgi Fuqarolik kodeksining 4-moddasi", {}), ("FK 4-moddasi", {}), ("shu Kodeksning 4-moddasi", {}),
        ("bemorda FK III aniqlandi", {"allow_fk_alias": True}), ("UFK 4-moddasi", {"allow_fk_alias": True}), (None, {}), ("", {}),
    ):
        assert extract(text, **given) == []


def test_what_stands_in_parentheses():
    """Records of publication and namings are passed over; titles between numbers too."""
    assert [c.article for c in extract("Fuqarolik kodeksi (Axborotnoma, 1999-yil, № 4, 77-modda) 15-moddasiga")] == ["15"]
    assert [c.article for c in extract("Fuqarolik kodeksi (keyingi matnda Kodeks deb ataladi) 16-moddasiga")] == ["16"]
    assert [c.article for c in extract("Fuqarolik kodeksining 17 (“Muddatlar”), 18-moddalari (“Muddatni tiklash”)")] == ["17", "18"]


@pytest.mark.parametrize("doc_type, more", [("law", True), ("constitution", True), ("code", False), (None, False)])
def test_a_bare_code_depends_on_the_citing_act(doc_type, more):
    found = extract("Fuqarolik kodeksining 40-moddasi va Kodeksning 41-moddasi", doc_type=doc_type)
    assert [c.article for c in found] == ["40", "41"][: 1 + more]


def test_order_of_what_is_found():
    """Clauses as they stand, then parts in Roman numerals, then chapters that are called parts."""
    found = extract("Fuqarolik kodeksining II boʻlimi, 3-boʻlimi, 9-bobi va 44-moddasi")
    assert [c.target_kind for c in found] == ["chapter", "article", "part", "chapter"] and [c.struct_number for c in found] == [9, None, 2, 3]


def test_target_doc(spark):
    df = spark.createDataFrame([("173",), ("1737",), ("2591",), ("11071",), ("700",), ("99999",)], "article string")
    assert [r[0] for r in df.select(target_doc(df.article)).collect()] == [GENERAL, GENERAL, GENERAL, SPECIAL, SPECIAL, None]


def test_table_function(spark):
    rows = [(1, False, False, "law", "Fuqarolik kodeksining 5-moddasi", None), (2, True, False, "law", "matn", "FK 6-moddasi"), (3, False, False, None, None, "")]
    df = spark.createDataFrame(rows, "row_id long, allow_fk_alias boolean, is_the_code boolean, doc_type string, article_text string, amendment_note string")
    got = citations(spark, df, ("article_text", "amendment_note")).orderBy("row_id").collect()
    assert [(r.row_id, r.source_field, r.article) for r in got] == [(1, "article_text", "5"), (2, "amendment_note", "6")]
    assert ExtractCitations is not None
