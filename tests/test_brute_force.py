"""Random input against small direct restatements of the rules."""

import random
import re
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from leafmill.functions import sections as sx
from leafmill.operators import manifest, pages
from leafmill.operators.runs import with_run_start
from leafmill.spec import DEFAULT_SPEC

WORDS = ["Make", "Model Name", "- ", "-", "--", " ", "\t", "x", "Some words", "a - b", "No Data", "n/a",
         "Cross-References", "Also Known As", "Notes", "\xa0", "\x1c", "\r", "Make - ", "B -- ", "é", ""]


def random_notes(rng):
    lines = ["".join(rng.choice(WORDS) for _ in range(rng.randint(0, 4))) for _ in range(rng.randint(0, 9))]
    return "intro\nNotes" + rng.choice(["", " ", "\n", " \n "]) + "\n" + "\n".join(lines)


def expected_notes(text):
    if "Notes" not in text:
        return None
    after = re.split(r"(?i)notes\s*\n", text, maxsplit=1)
    if len(after) == 1:
        return None
    body = re.split("Cross-References|Also Known As|Firearms Reference Table", after[1])[0].strip()
    if body.lower() in ("", "no data", "n/a"):
        return None
    entries = []
    for line in filter(None, map(str.strip, body.split("\n"))):
        opened = re.fullmatch(r"([A-Z][A-Za-z ]{1,49}?)\s*--?\s+(.+)", line)
        if opened:
            first, *rest = opened[1].split()
            entries.append([first.lower() + "".join(map(str.capitalize, rest)), [opened[2].strip()]])
        elif entries and line.startswith("- "):
            entries[-1][1].append(line[2:].strip())
        elif entries:
            entries[-1][1][-1] += " " + line
    final = {}
    for key, bullets in entries:
        final[key] = bullets
    return list(final.items()) or None


def test_notes(spark):
    rng = random.Random(1)
    texts = [random_notes(rng) for _ in range(4000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r["i"]: r["notes"] for r in pages.with_notes(df).select("i", "notes").collect()}
    for i, text in enumerate(texts):
        mine = [(n["note_key"], n["bullets"]) for n in got[i] or []] or None
        assert mine == expected_notes(text), repr(text)


TOKENS = ["5", "12", "400", "WIN", "CC", "84(3)", "para.", "Manufacturer", "Non-Commercial", "Antique", "\xb2", "6x"]
LINES = ["Calibre Shots Barrel", "Calibre Shots", "Notes", "Year Dates: 3", "", "Barrel Shots Calibre Notes"]


def random_table(rng):
    out = []
    for _ in range(rng.randint(1, 10)):
        if rng.random() < 0.35:
            out.append(rng.choice(LINES))
        else:
            gap = rng.choice(["", " ", "\t", "  "])
            rest = rng.choice([" ", "  "]).join(rng.choice(TOKENS) for _ in range(rng.randint(0, 9)))
            out.append(f"{rng.choice(['', ' '])}7{gap}-{gap}{rng.randint(1, 3)} {rest}")
    return "\n".join(out)


def expected_rows(text):
    if not all(w in text for w in ("Calibre", "Shots", "Barrel")):
        return []
    rows, reading = [], False
    for line in text.split("\n"):
        if all(w in line for w in ("Calibre", "Shots", "Barrel")):
            reading = True
        elif re.search("Notes|Cross-References|Also Known|Year Dates|Importer", line):
            reading = False
        elif reading and (m := re.match(r"\s*(\d+\s*-\s*\d+)\s+(\S.*)", line)):
            tokens = m[2].split()
            pairs = [i for i in range(len(tokens) - 1) if tokens[i].isdigit() and tokens[i + 1].isdigit()]
            if not pairs:
                continue
            at, tail = pairs[-1], tokens[pairs[-1] + 2:]
            if tail[:1] == ["CC"]:
                stops = [i for i, t in enumerate(tail) if t in ("para.", "Non-Commercial", "Manufacturer")]
                tail = tail[:min([6, *stops])]
            else:
                tail = tail[:1]
            rows.append((m[1].replace(" ", ""), " ".join(tokens[:at]) or None, tokens[at],
                         tokens[at + 1], " ".join(tail) or None))
    return rows


def test_table_rows(spark):
    rng = random.Random(2)
    texts = [random_table(rng) for _ in range(4000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r["i"]: r["sub_entries"] for r in pages.with_sub_entries(df).select("i", "sub_entries").collect()}
    for i, text in enumerate(texts):
        assert [tuple(e) for e in got[i] or []] == expected_rows(text), repr(text)


def test_long_sections_do_not_overflow(spark):
    rows = "\n".join(f"1 - {i} 22 5 100 Antique" for i in range(20000))
    bullets = "\n".join(f"- bullet {i}\nwrapped" for i in range(20000))
    text = f"Calibre Shots Barrel\n{rows}\nNotes\nMake - a\n{bullets}\nCross-References\n" + "\n".join(
        f"{i} ref" for i in range(20000))
    df = spark.createDataFrame([(text,)], "text string")
    out = df.transform(pages.with_sub_entries).transform(pages.with_notes).transform(
        pages.with_cross_references)
    (row,) = out.select(
        F.size("sub_entries"), F.size(F.col("notes")[0]["bullets"]), F.size("cross_references")).collect()
    assert tuple(row) == (20000, 20001, 20000)


PIECES = ["Make:", "make :", "MODEL:", "Model: ", "Type:", "Year Dates:", "Country of Manufacturer:",
          "Serial Numbering:", "See Note", "see note", "See  Note", "No Data", "no  data", "\n", "\n", "\n",
          "\n\n", " ", "\xa0", "\t", "value", "two  words", "Notes", "\nNotes\n", "the year: 1950", "serial x",
          "a date", "manufacturer: ", "make: it", "\r", "\x85", "type"]


def expected_fields(text):
    labels = dict(DEFAULT_SPEC.fields)
    known = "|".join(map(re.escape, labels.values()))
    notes = re.search(r"(?is)notes\s*\n(.*?)(?:\n\n|\Z)", text)
    notes = notes[1].strip() if notes else ""

    def looked_up(field):
        for line in notes.split("\n"):
            if any(w in line.lower() for w in DEFAULT_SPEC.keywords(field)):
                value = line.partition(":")[2].strip() if ":" in line else line.strip()
                if value.lower() not in ("", "see note", "no data"):
                    return value

    out = {}
    for field, label in labels.items():
        hit = re.search(rf"(?im)^{re.escape(label)}:\s*([^\n]+)", text)
        value = re.split(rf"(?i)\s+(?:{known})\s*:", hit[1].strip())[0].strip() if hit else ""
        if re.match(rf"(?i)(?:{known})\s*:", value):
            value = ""
        if value.lower() == "see note" and notes:
            out[field] = looked_up(field)
        else:
            value = " ".join(value.split())
            out[field] = None if value.lower() in ("", "no data") else value
    return out


def test_fields(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(1, 25))) for _ in range(6000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r["i"]: r for r in df.transform(pages.with_fields).collect()}
    for i, text in enumerate(texts):
        want = expected_fields(text)
        assert {f: got[i][f] for f in want} == want, repr(text)


def random_pages(rng, docs, length):
    rows = []
    for d in range(docs):
        pos = 0
        for _ in range(length):
            pos += rng.choice([1, 1, 1, 2, 7, 40])
            rows.append((f"d{d}", pos, rng.choice([None, "1", "1", "1", "2", "3"])))
    return rows


def expected_runs(rows):
    out, last = [], {}
    for doc, pos, key in sorted(rows, key=lambda r: r[:2]):
        start = pos
        if doc in last and last[doc][0] == key:
            start = last[doc][1]
        last[doc] = (key, start)
        out.append((doc, pos, key, start if key is not None else None))
    return out


@pytest.mark.parametrize("partitions", [1, 2, 5, 16, 90, None])
def test_runs_over_ranges(spark, partitions):
    rows = random_pages(random.Random(partitions or 0), 3, 250)
    df = spark.createDataFrame(rows, "doc_id string, page_idx bigint, frn string")
    got = with_run_start(df, "frn", partitions=partitions).collect()
    assert sorted(map(tuple, got), key=lambda r: r[:2]) == expected_runs(rows)


def test_page_lists_of_hot_key_are_split_not_cut(spark):
    """One key owns every page: its list comes in bounded parts and is complete."""
    df = spark.range(1000).select(
        F.lit("d").alias("doc_id"), F.col("id").alias("page_idx"), F.lit("9").alias("frn"))
    parts = manifest.run_parts(df, partitions=6, part=64)
    assert parts.count() == 16
    lists = manifest.page_lists(manifest.pages_of_parts(df, manifest.last_parts(parts), part=64), part=64)
    rows = sorted(lists.collect(), key=lambda r: r["part"])
    assert [len(r["page_indices"]) for r in rows] == [64] * 15 + [40]
    assert [i for r in rows for i in r["page_indices"]] == list(range(1000))


def test_last_runs_of_random_pages(spark):
    rows = random_pages(random.Random(5), 2, 300)
    df = spark.createDataFrame(rows, "doc_id string, page_idx bigint, frn string")
    parts = manifest.run_parts(df, partitions=9, part=32)
    kept = manifest.pages_of_parts(df, manifest.last_parts(parts), part=32)
    runs = {}
    for (doc, key, start), group in groupby(
            (r for r in expected_runs(rows) if r[2]), key=lambda r: (r[0], r[2], r[3])):
        runs[doc, key] = [(doc, key, r[1], start) for r in group]
    want = sorted(r for run in runs.values() for r in run)
    got = sorted((r["doc_id"], r["frn"], r["page_idx"], r["run_start"]) for r in kept.collect())
    assert got == want
