import pytest

from pairloom.functions.romanize import romanize_text
from pairloom.operators.normalize import normalize
from pairloom.operators import translit
from pairloom.operators.translit import learn_dictionary

ROWS = [
    (1, "Green Leaf.com", "12 Long Street, Springfield"),
    (2, "Gr Eenleaf Inc.", "0012 Long Str, Springfield"),
    (3, "Alpha Alpha Private (Limited)", "<NULL>"),
    (4, "Bread + Butter", "Unit B-11/2, 4th North Avenue"),
    (5, "Bread & Butter", "unit b-1-1/2 4 South avenue"),
    (6, "Café Crème SARL", "14 R. de la Paix, Paris"),
    (7, "m0torola 24", None),
    (8, "Acme L.L.C. (ID: 29782)", "null"),
    (9, "Acme P.C. 5551234567", " , "),
    (10, "The Company", "x"),
    (11, None, "0"),
    (12, "Liberty", "y"),
    (13, "llberty", "y"),
]


@pytest.fixture(scope="module")
def found(spark):
    df = spark.createDataFrame(ROWS, "idx int, business_name string, business_address string")
    return {r.idx: r for r in normalize(df).collect()}


def test_names(found):
    assert found[1].name_website and not found[2].name_website
    assert found[1].name_compact == found[2].name_compact == "greenleaf"
    assert found[3].name_tokens == ["alpha"] and found[3].legal_form == "ltd pvt"
    assert found[4].name_tokens == found[5].name_tokens == ["bread", "butter"]
    assert found[6].name_tokens == ["cafe", "creme"] and found[6].legal_form == "sarl"
    assert found[7].name_tokens == ["motorola", "24"]
    assert found[8].name_tokens == ["acme"] and found[8].legal_form == "llc"
    assert found[9].name_tokens == ["acme"] and found[9].legal_form == "pc"
    assert found[10].name_tokens == [] and found[10].name_core == "the company" and found[10].name_compact == "thecompany"
    assert found[11].name_norm == "" and found[11].name_tokens == []
    assert found[12].name_skel == found[13].name_skel


def test_addresses(found):
    assert found[1].street_key == found[2].street_key == "12_long"
    assert found[1].addr_tokens == found[2].addr_tokens
    assert found[3].addr_empty and found[7].addr_empty and found[8].addr_empty and found[9].addr_empty
    # north becomes n, which is dropped; south becomes s, which stays
    assert found[4].addr_tokens == ["b", "11", "2", "4", "ave"]
    assert found[5].addr_tokens[-2:] == ["s", "ave"]
    assert "b112" in found[4].addr_ids and "b112" in found[5].addr_ids
    assert found[6].addr_tokens == ["14", "rue", "paix", "paris"]
    assert found[4].addr_numbers == ["11", "2", "4"] and found[11].house_no == "0"


def test_dictionary(spark):
    rows = [("Green Private", "हरा प्राइवेट")] * 2 + [("Red Private", "लाल, प्राइवेट"), ("Blue Limited", "नीला")]
    learned = learn_dictionary(spark.createDataFrame(rows, "n1 string, n2 string"))
    assert {(r.word, r.latin) for r in learned.collect()} == {("प्राइवेट", "private"), ("हरा", "green")}
    df = spark.createDataFrame([(1, "हरा प्राइवेट", "")], "idx int, business_name string, business_address string")
    for known in (translit.transliterated(df, learned), translit.joined(df, learned)):
        row = normalize(known).first()
        assert row.name_nonlatin and row.name_tokens == ["green"] and row.legal_form == "pvt"


def test_large_dictionaries_are_joined(spark, monkeypatch):
    rows = [(1, "हरा  प्राइवेट", ""), (2, "Plain Name", ""), (3, None, ""), (4, "हरा", ""), (5, "", "")]
    df = spark.createDataFrame(rows, "idx int, business_name string, business_address string")
    learned = spark.createDataFrame([("हरा", "green"), ("plain", "never")], "word string, latin string")
    small = sorted(map(tuple, translit.transliterated(df, learned).select("idx", "latin_name").collect()))
    assert small == [(1, "green प्राइवेट"), (2, "plain name"), (3, ""), (4, "green"), (5, "")]
    monkeypatch.setattr(translit, "MOST_WORDS", 1)
    assert sorted(map(tuple, translit.transliterated(df, learned).select("idx", "latin_name").collect())) == small
    with pytest.raises(ValueError):
        translit.lookup(learned)


def test_romanize():
    assert romanize_text("plain") == "plain" and romanize_text(None) is None
    assert romanize_text("Москва").isascii() and romanize_text("राम") == "raama"
    assert romanize_text("é") == "e" and romanize_text("œuf ß") == "oeuf ss"
