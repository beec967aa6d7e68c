"""Extraction against hand-written cases and plain line-by-line loops."""

import random
import re

import pytest
from pyspark.sql import functions as F

from folioscope import fixed_values as fv
from folioscope.functions import extract, text
from folioscope.operators import conservative, extraction, lines


def apply(spark, fn, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("t")).alias("r")).collect()]


def fields(items, *names):
    return [tuple(x[n] for n in names) for x in items]


def test_lines_are_stripped_and_blanks_dropped(spark):
    (got,) = apply(spark, text.text_lines, " a b \n\n\t\n c \r\n\x1cd")
    assert got == ["a b", "c", "d"]


def test_squeeze_and_tokens(spark):
    assert apply(spark, text.squeeze, "  a\t b\n\nc  d\te ") == ["a b c d e"]
    samples = ["", "one", "a b c", "w " * 77, "x y"]
    want = [int(len(s.split()) * 1.3) for s in samples]
    assert apply(spark, text.token_estimate, *samples) == want


def test_short_continuation_lines_are_skipped(spark):
    (got,) = apply(
        spark, extract.page_footnotes, "1 ICC-01/04, para. 5\nshort\nthis line is longer"
    )
    assert fields(got, "number", "content") == [("1", "ICC-01/04, para. 5 this line is longer")]


def test_invalid_start_closes_the_open_footnote(spark):
    (got,) = apply(
        spark,
        extract.page_footnotes,
        "1 ICC-01/04, para. 5\n2 14 March 2014, T-1\nsome longer tail text",
    )
    assert fields(got, "number", "content") == [("1", "ICC-01/04, para. 5")]


def test_number_alone_on_a_line_is_no_footnote(spark):
    (got,) = apply(spark, extract.page_footnotes, "1 ICC-01/04, para. 5\n12\nICC-99 and more text")
    assert fields(got, "number", "content") == [
        ("1", "ICC-01/04, para. 5 ICC-99 and more text")
    ]


def test_decimal_starts_a_paragraph(spark):
    (got,) = apply(spark, extract.page_paragraphs, "4.5 million people " + "word " * 12)
    assert got[0]["number"] == "4" and got[0]["content"].startswith("5 million")


def test_repeated_number_after_invalid_block_is_kept(spark):
    body = "the chamber finds that this is long enough to be kept here"
    (got,) = apply(spark, extract.page_paragraphs, f"7. tiny\n7. {body}\n7. {body} again")
    assert fields(got, "number", "content", "start_line", "end_line") == [("7", body, 1, 2)]


def test_references_are_runs_of_up_to_three_digits(spark):
    assert apply(spark, extract.footnote_references, "in 2014 and 7") == [["201", "4", "7"]]


def test_brackets_end_at_any_bracket(spark):
    long = "word " * 12
    (got,) = apply(
        spark, extract.bracket_paragraphs, f"[1] {long}[sic] more [2] text [x3] [ 4] [5]{long}\n\n{long}"
    )
    assert fields(got, "number", "content") == [
        ("1", long.strip()),
        ("5", f"{long.strip()} {long.strip()}"),
    ]


def test_first_pattern_in_the_list_names_the_section(spark):
    got = apply(
        spark,
        extract.section_marker,
        "VII. VERDICT\nI. OVERVIEW",
        "vii.  verdict",
        "II.\nFINDINGS OF  FACT",
        "nothing V. Smith",
        "II. OVERVIEW",
    )
    assert got == ["OVERVIEW", "VERDICT", "FINDINGS_OF_FACT", None, "OVERVIEW"]


def test_conservative_footnote_content_follows_the_match(spark):
    line = "5 See ICC-01/04, Trial Chamber judgment, para. 3"
    (got,) = apply(spark, extract.conservative_page_footnotes, line)
    assert fields(got, "number", "content") == [("5", line[6:])]
    assert got[0]["confidence"] == pytest.approx(0.7)


def test_conservative_duplicates_keep_the_best_then_the_first(spark):
    base = "See ICC-01/04, Trial Chamber judgment, para. 3"
    page = f"5 {base} a\n5 {base} decision b\n5 {base} decision c\n4 {base} d"
    (got,) = apply(spark, extract.conservative_page_footnotes, page)
    assert [(x["number"], x["content"][-1]) for x in got] == [("5", "b"), ("4", "d")]


def test_excluded_lines_are_case_sensitive(spark, make_pages):
    pages = make_pages(
        [(1, 1, "12 See Appeals Chamber para. 4\n12 see appeals chamber para. 4\nshort line\nJudge A Presiding over")]
    )
    got = [r["line"] for r in lines.footnote_candidate_lines(pages).collect()]
    assert got == ["12 see appeals chamber para. 4"]


# --- plain loops, written from the rules ---------------------------------------


def loop_lines(page):
    kept = [x.strip() for x in page.split("\n")]
    return [x for x in kept if x and not any(re.search(p, x) for p in fv.HEADER_PATTERNS)]


def loop_footnotes(page):
    out, is_open = [], False
    for line in loop_lines(page):
        start = re.match(r"(\d{1,3})\s+(.*)", line, re.S)
        if start:
            number, head = start.groups()
            dated = any(re.search(p, head, re.I) for p in fv.DATE_PATTERNS)
            cited = any(re.search(p, head) for p in fv.CITATION_PATTERNS)
            is_open = len(head) >= 10 and cited and not dated
            if is_open:
                score = sum(w for p, w in fv.HYBRID_CONFIDENCE_WEIGHTS if re.search(p, head))
                score += 0.1 if len(head) > 50 else 0
                out.append([number, head, min(score, 1.0)])
        elif is_open and len(line) > 10:
            out[-1][1] += " " + line
    return [tuple(x) for x in out]


def loop_paragraphs(page):
    rows, blocks = loop_lines(page), []
    for i, line in enumerate(rows):
        start = re.match(r"(\d{1,4})\.", line)
        if start:
            blocks.append([start.group(1), i, i + 1, [line[start.end() :].strip()]])
        elif blocks:
            blocks[-1][2] = i + 1
            blocks[-1][3].append(line)
    out, seen = [], set()
    for number, first, last, parts in blocks:
        body = " ".join(parts).strip()
        named = any(w in body.lower() for w in fv.PARAGRAPH_WORDS)
        if len(body) >= 50 and (named or len(body.split()) >= 10) and number not in seen:
            seen.add(number)
            out.append((number, body, first, last, int(len(body.split()) * 1.3)))
    return out


PIECES = [
    "7 See ICC-01/14, para. 12", "7  ", "12", "3 P-0123: T-045, p. 3", "15 12 March 2014, T-3",
    "1999 T-3", "4. short", "12. The Chamber notes that witness one spoke for long about it",
    "12. aaaa bbbb cccc dddd eeee ffff gggg hhhh iiii jjjj kkkk", "0012.5 of evidence is left",
    "tiny", "a somewhat longer line of text", "12/13", "No. ICC-01/14 header", " ", "\t x  ",
    "8 Article 5 of the été statute; 4 été 2014 T-1", "99 Rule 7 and so on", "5.", "6 ICC-2 cited again",
]


def random_pages(n):
    rng = random.Random(5)
    return ["\n".join(rng.choices(PIECES, k=rng.randint(0, 14))) for _ in range(n)]


def test_footnotes_agree_with_a_line_loop(spark):
    pages = random_pages(1500)
    for page, got in zip(pages, apply(spark, extract.page_footnotes, *pages)):
        want = loop_footnotes(page)
        assert fields(got, "number", "content") == [w[:2] for w in want], page
        assert [x["confidence"] for x in got] == pytest.approx([w[2] for w in want])


def test_paragraphs_agree_with_a_line_loop(spark):
    pages = random_pages(1500)
    names = ("number", "content", "start_line", "end_line", "token_count")
    for page, got in zip(pages, apply(spark, extract.page_paragraphs, *pages)):
        assert fields(got, *names) == loop_paragraphs(page), page


# --- tables --------------------------------------------------------------------

NOTE = "1 ICC-01/04, para. 5"
PARA = "2. The Chamber notes that this paragraph is long enough to stay"


def test_two_texts(make_pages):
    pages = make_pages([(1, 7, NOTE, PARA), (1, 8, NOTE, ""), (1, 9, NOTE, None), (1, 10, None, PARA)])
    status = extraction.page_status(extraction.extract_pages(pages)).orderBy("page").collect()
    got = [(r["page"], r["success"], r["paragraph_count"], r["footnote_count"]) for r in status]
    assert got == [(7, True, 1, 1), (8, True, 0, 1), (9, True, 0, 1), (10, False, 0, 0)]
    (stats,) = extraction.run_statistics(
        extraction.page_status(extraction.extract_pages(pages))
    ).collect()
    assert tuple(stats) == (4, 3, 1, 1, 3)


def test_page_skip_and_limit(make_pages):
    pages = make_pages([(1, i, NOTE) for i in range(1, 13)])
    got = extraction.extract_pages(pages, max_pages=10).select("page_no").collect()
    assert sorted(r[0] for r in got) == [7, 8, 9, 10]


def test_sections_carry_across_blocks(make_pages):
    texts = ["x", "I. OVERVIEW", "y", "z", "z", "z", "VII. VERDICT", "q", "q"]
    pages = make_pages(
        [(1, i + 1, t) for i, t in enumerate(texts)] + [(2, 1, "x"), (2, 9, "VI. SENTENCE"), (2, 40, "x")]
    )
    want = {(1, i + 1): "HEADER" if i < 1 else "OVERVIEW" if i < 6 else "VERDICT" for i in range(9)}
    want |= {(2, 1): "HEADER", (2, 9): "SENTENCE", (2, 40): "SENTENCE"}
    for size in (1, 2, 3, 65536):
        got = conservative.page_sections(pages, pages_per_block=size).collect()
        assert {(r["doc_id"], r["page"]): r["section_type"] for r in got} == want


def test_page_limit_holds_for_paragraphs_only(make_pages):
    body = "[1] " + "word " * 12
    pages = make_pages([(1, 1, body), (1, 2, body), (1, 3, "VII. VERDICT")])
    got = conservative.clean_paragraphs(pages, max_pages=1).collect()
    assert [(r["id"], r["page"]) for r in got] == [("para_HEADER_1_1", 1)]
    assert conservative.page_sections(pages).count() == 3
