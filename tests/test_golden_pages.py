"""Hand-written pages: the sample record and every known trap, one page each."""

import pytest

from leafmill.operators.assemble import assemble, assemble_global
from leafmill.operators.pages import extracts_of, page_extract, page_facts

KEY = "Firearm Reference Number (FRN): "
TABLE = "Calibre, Shots and Barrel Length\n"

SAMPLE = KEY + """166062
Make: 2 Vets Arms
Model: 2VA-10
Manufacturer: 2 Vets Arms
Level: Manufacturer Specifications and Commercial Customization
Type: Rifle
Action: Semi-Automatic
Country of Manufacturer: UNITED STATES OF AMERICA
Legal Classification: Prohibited
Serial Numbering: serial-numbered on the receiver/frame.
Year Dates: No Data
Importer: NO DATA
FRN Calibre Shots Barrel Classification
166062 - 1 308 WIN 5 457 Prohibited para. 12(9) Manufacturer Specifications
Notes
Make - the 2 Vets Arms name and logo is marked on the firearm.
Model - "2VA-10" is marked on the right side of the receiver/frame.
- introduced in 2015,
and sold since.
Action - gas-operated.
Cross-References
FRN Make Model
176685 Stealth Arms 1911 Government
Also Known As
1 not a reference
"""

PAGES = {
    "sample": SAMPLE,
    "next_line": KEY + "1\nMake:\n   Foo  Bar \nModel:\nType: x\n",
    "merged": KEY + "2\nMake: A  model : B\nLevel: Type: x\n",
    "see_note_alone": KEY + "3\nMake: See Note\n",
    "see_note_spaced": KEY + "4\nMake: See  Note\nNotes\nmake: Other\n",
    "see_note_found": (KEY + "5\nYear Dates: SEE NOTE\nSerial Numbering: see note\nMake: See Note\n"
                       "Country of Manufacturer: See Note\nNotes\nthe date: No Data\nYear  1950\n"
                       "Serial: a : b\nCross-References\n77 Manufacturer X\n"),
    "repeated_key": KEY + "6\nNotes\nMake - a\nModel - b\nMAKE - no, all caps is a heading too\nMake - c\n- d\n",
    "before_heading": KEY + "7\nNotes\n- lost\nalso lost\nMake - kept\n",
    "prose_heading": KEY + "8\nNotes\nMake - one\nWords here - more\n-\n- x\n-y\nMake -\nM - short\n",
    "capitals_only": KEY + "9\nNOTES\nMake - a\n",
    "no_data_notes": KEY + "10\nNotes\n No Data \n\n",
    "calibres": (KEY + "11\n" + TABLE + "11 - 1 10 400 Restricted\n11 -2 38 5 102\n11-3 44 COLT 6 152 Antique x\n"
                 "11 - 4 22 LR 10\n11 - 5 9 MM 1 2 3 Antique\nrow 11 - 6 1 2\n11 - 7 5\n"),
    "classes": (KEY + "12\n" + TABLE + '12 - 1 22 5 100 CC 2 "firearm" para. 5\n'
                "12 - 2 22 5 100 CC a b c d e f g\n12 - 3 22 5 100 CC\n12 - 4 22 5 100 CC 84(3) 7 8 9 x\n"
                "12 - 5 22 5 100 CC Manufacturer\n12 - 6 22 5 100 Non-Restricted\n"),
    "reopened": (KEY + "13\n13 - 0 1 2\n" + TABLE + "13 - 1 1 2\nYear Dates: x\n13 - 2 1 2\n"
                 "Shots Barrel Calibre 13 - 3 3 4\n13 - 4 1 2\nImporter: y\n13 - 5 1 2\n"),
    "line_ends": KEY + "14\r\nMake: A\r\nModel: B\x85Type: C\r\nNotes\r\nMake - a\r\n- b\r\n",
    "wide_blanks": KEY + "15\nMake:\xa0A\xa0\u2003B\xa0\nModel: \x1cC\x1d\n" + TABLE + "15\xa0- 1 \xb2 5 \u0663\n",
    "two_keys": "see " + KEY + "16\nfirearm reference number (frn):  17\nMake: x\n",
    "sub_page": KEY + "18\nMake: x\n" + KEY + "18 -  2\n",
    "no_data_spaced": KEY + "19\nMake: no  DATA\nModel:  No Data \nLevel: no data x\n",
    "dashes": KEY + "20\nNotes\nCanadian LAW Comments -- a--b\nMake - -- c - d\nmodel - lower case\n",
    "xrefs": KEY + "21\nNotes\nMake - x\ncross-references  \nCross-References\n  5   A  B \n6\n7 C\nx 8 D\nFirearms Reference Table\n9 E\n",
    "inner_label": KEY + "23\nYear Dates:\nCountry of Manufacturer: X\n",
    "folded_case": KEY + "24\nMA\u212aE: a\nSerial Number\u0131ng: b\nYear Date\u017f: c\n",
    "first_wins": KEY + "22\nMake: first\nMake: second\nmodel: any case\n",
}


def sub(frn, calibre, shots, barrel, cls):
    return (frn, calibre, shots, barrel, cls)


EXPECTED = {
    "sample": {
        "frn": "166062", "make": "2 Vets Arms", "model": "2VA-10", "manufacturer": "2 Vets Arms",
        "level": "Manufacturer Specifications and Commercial Customization", "type": "Rifle",
        "action": "Semi-Automatic", "country": "UNITED STATES OF AMERICA",
        "legal_classification": "Prohibited", "year_dates": None, "importer": None,
        "serial_numbering": "serial-numbered on the receiver/frame.",
        "notes": [
            ("make", ["the 2 Vets Arms name and logo is marked on the firearm."]),
            ("model", ['"2VA-10" is marked on the right side of the receiver/frame.',
                       "introduced in 2015, and sold since."]),
            ("action", ["gas-operated."])],
        "sub_entries": [sub("166062-1", "308 WIN", "5", "457", "Prohibited")],
        "cross_references": [("176685", "Stealth Arms 1911 Government")],
    },
    "next_line": {"make": "Foo Bar", "model": None, "type": "x"},
    "merged": {"make": "A", "model": None, "level": None, "type": None},
    "see_note_alone": {"make": "See Note"},
    "see_note_spaced": {"make": "See Note"},
    "see_note_found": {"year_dates": "Year  1950", "serial_numbering": "a : b", "make": None,
                       "country": "77 Manufacturer X", "notes": None},
    "repeated_key": {"notes": [("make", ["c", "d"]), ("model", ["b"])]},
    "before_heading": {"notes": [("make", ["kept"])]},
    "prose_heading": {"notes": [
        ("make", ["one"]), ("wordsHere", ["more -", "x -y Make -"]), ("m", ["short"])]},
    "capitals_only": {"notes": None},
    "no_data_notes": {"notes": None},
    "calibres": {"sub_entries": [
        sub("11-1", None, "10", "400", "Restricted"), sub("11-2", "38", "5", "102", None),
        sub("11-3", "44 COLT", "6", "152", "Antique"), sub("11-5", "9 MM 1", "2", "3", "Antique")]},
    "classes": {"sub_entries": [
        sub("12-1", "22", "5", "100", 'CC 2 "firearm"'), sub("12-2", "22", "5", "100", "CC a b c d e"),
        sub("12-3", "22", "5", "100", "CC"), sub("12-4", "22 5 100 CC 84(3) 7", "8", "9", "x"),
        sub("12-5", "22", "5", "100", "CC"), sub("12-6", "22", "5", "100", "Non-Restricted")]},
    "reopened": {"sub_entries": [sub("13-1", None, "1", "2", None), sub("13-4", None, "1", "2", None)],
                 "year_dates": "x", "importer": "y"},
    "line_ends": {"make": "A", "model": "B", "type": None, "notes": [("make", ["a", "b"])]},
    "wide_blanks": {"make": "A B", "model": "C",
                    "sub_entries": [sub("15\xa0-1", "\xb2", "5", "\u0663", None)]},
    "two_keys": {"frn": "16", "printed_key": "17", "make": "x"},
    "no_data_spaced": {"make": None, "model": None, "level": "no data x"},
    "dashes": {"notes": [("canadianLawComments", ["a--b"]), ("make", ["-- c - d model - lower case"])]},
    "xrefs": {"notes": [("make", ["x cross-references"])],
              "cross_references": [("5", "A  B"), ("7", "C")]},
    # The label on the next line ends in another label, so its first words stay as a value.
    "inner_label": {"year_dates": "Country of", "country": "X"},
    "folded_case": {"make": "a", "serial_numbering": "b", "year_dates": "c"},
    "first_wins": {"make": "first", "model": "any case"},
}
# Three digit tokens in a row: the rightmost pair is taken, so a superscript calibre stays left.
SKIPPED = {"sub_page"}


@pytest.fixture(scope="module")
def page_table(spark):
    rows = [(name, 0, text) for name, text in PAGES.items()]
    return spark.createDataFrame(rows, "doc_id string, page_idx bigint, text string")


@pytest.fixture(scope="module")
def extracted(page_table):
    return {r["doc_id"]: r for r in page_extract(page_table).collect()}


def plain(value):
    if isinstance(value, list):
        if not value:
            return None
        return [plain(v) for v in value]
    if hasattr(value, "asDict"):
        return tuple(plain(v) for v in value)
    return value


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_page(extracted, name):
    row = extracted[name]
    got = {field: plain(row[field]) for field in EXPECTED[name]}
    assert got == EXPECTED[name]


def test_skipped_pages(extracted):
    assert set(PAGES) - set(extracted) == SKIPPED


def test_page_facts_hold_the_same(page_table, extracted):
    again = {r["doc_id"]: r for r in extracts_of(page_facts(page_table)).collect()}
    assert again == extracted
    facts = page_facts(page_table)
    assert facts.count() == len(PAGES)
    heads = {r["doc_id"]: r["head_frn"] for r in facts.collect()}
    assert heads["sub_page"] == "18" and heads["two_keys"] == "16"


def test_printed_key_names_the_record(page_table):
    by_doc = {r["doc_id"]: r for r in assemble_global(page_extract(page_table)).collect()}
    assert (by_doc["two_keys"]["page_key"], by_doc["two_keys"]["frn"]) == ("16", "17")


def test_unknown_mode(page_table):
    with pytest.raises(ValueError):
        assemble(page_extract(page_table), "other")


def test_merge_rules(spark):
    def page(i, *body):
        return ("d", i, KEY + "1\n" + "\n".join(body))

    note, table = "Notes\nMake - ", TABLE + "1 - 1 22 "
    pages = spark.createDataFrame([
        page(3, "Make: early", "Model: only", note + "page three"),
        page(5, "Make: late", table + "5 100", note + "page five"),
        page(9, "Make: No Data", table + "6 200"),
    ], "doc_id string, page_idx bigint, text string")
    (row,) = assemble_global(page_extract(pages)).collect()
    assert (row["make"], row["model"], row["first_page_idx"], row["n_pages"]) == ("late", "only", 3, 3)
    assert plain(row["notes"]) == [("make", ["page three"])]
    assert plain(row["sub_entries"]) == [sub("1-1", "22", "5", "100", None)]
