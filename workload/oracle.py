"""The registered queries in DuckDB SQL, written independently of the Spark jobs:
line tables, windows and a recursive walk instead of in-row arrays."""

from __future__ import annotations

from folioscope import fixed_values as fv
from workload.fixtures import HEADINGS, SAMPLE_QUERIES, SEARCH_SECTIONS


def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def lits(values) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


def pick(values, index: str) -> str:
    return f"({lits(values)})[({index}) % {len(values)} + 1]"


def matches(text: str, pattern: str, flags: str = "c") -> str:
    return f"regexp_matches({text}, {lit(pattern)}, '{flags}')"


def any_match(text: str, patterns, flags: str = "c") -> str:
    return "(" + " OR ".join(matches(text, p, flags) for p in patterns) + ")"


def any_contained(text: str, words) -> str:
    return "(" + " OR ".join(f"contains({text}, {lit(w)})" for w in words) + ")"


def strip(text: str) -> str:
    return rf"regexp_replace({text}, '^\s+|\s+$', '', 'g')"


def words(text: str) -> str:
    return rf"len(regexp_extract_all({text}, '\S+'))"


def tokens(text: str) -> str:
    return f"CAST(floor({words(text)} * CAST({fv.TOKENS_PER_WORD} AS DOUBLE)) AS INTEGER)"


def dbl(value: float) -> str:
    return f"CAST({value} AS DOUBLE)"


def summed(text: str, weights) -> str:
    return " + ".join(
        ["CAST(0 AS DOUBLE)"]
        + [f"CASE WHEN {matches(text, p)} THEN {dbl(w)} ELSE {dbl(0)} END" for p, w in weights]
    )


# --- base tables ---------------------------------------------------------------

DOC_LINES = """
doc_lines AS (
  SELECT doc_id, i::BIGINT AS i, ls[i + 1] AS line FROM
    (SELECT doc_id, string_split(text, chr(10)) AS ls,
            unnest(range(len(string_split(text, chr(10))))) AS i FROM documents))"""

LEGAL_PAGES = f"""{DOC_LINES},
marked AS (
  SELECT doc_id, i, (i // 10) + 1 AS page_no,
    concat(
      CASE WHEN i % 24 = CASE WHEN doc_id % 4 = 0 THEN 12 ELSE 0 END
           THEN concat({pick(HEADINGS, 'doc_id + i // 24')}, chr(10)) ELSE '' END,
      CASE (doc_id * 7 + i * 3) % 5
        WHEN 0 THEN concat('[', i + 1, '] ', line)
        WHEN 1 THEN concat(1 + CASE WHEN doc_id % 2 = 0 THEN i // 10 ELSE i // 5 END,
          CASE (i // 5) % 4
            WHEN 0 THEN concat(' See ICC-01/14-01/18, Trial Chamber judgment, para. ', i, '. ')
            WHEN 1 THEN concat(' See Katanga v. Ngudjolo, ICC-01/04, decision, para. ', i, '. ')
            WHEN 2 THEN concat(' Cf. Article ', i, ' of the statute, para. ', i, '. ')
            ELSE concat(' P-0', i, ': T-0', i, ', 12 March 2014, CAR-OTP, p. ', i, '. ') END, line)
        WHEN 2 THEN concat(CASE WHEN doc_id % 3 = 0 THEN i // 10 ELSE i END + 1,
          '. ', CASE WHEN i % 2 = 0 THEN 'The Chamber notes ' ELSE '' END, line)
        WHEN 3 THEN line
        ELSE concat('ICC-01/14-01/18-2784-Red 24-07-2025 ', i // 10 + 1, '/1616 T') END) AS txt
  FROM doc_lines),
legal_pages AS (
  SELECT doc_id, CAST(page_no AS INTEGER) AS page_no, string_agg(txt, chr(10) ORDER BY i) AS page_text
  FROM marked GROUP BY doc_id, page_no)"""

# stripped, non-blank lines with their place on the page
LINES = f"""{LEGAL_PAGES},
split_lines AS (
  SELECT doc_id, page_no, i, {strip('ls[i + 1]')} AS line FROM
    (SELECT doc_id, page_no, string_split(page_text, chr(10)) AS ls,
            unnest(range(len(string_split(page_text, chr(10))))) AS i FROM legal_pages)),
lines AS (
  SELECT doc_id, page_no, line,
    CAST(row_number() OVER (PARTITION BY doc_id, page_no ORDER BY i) - 1 AS INTEGER) AS line_no
  FROM split_lines WHERE line <> '')"""

CLEAN = f"""{LINES},
clean AS (
  SELECT doc_id, page_no, line,
    CAST(row_number() OVER (PARTITION BY doc_id, page_no ORDER BY line_no) - 1 AS INTEGER) AS line_no
  FROM lines WHERE NOT {any_match('line', fv.HEADER_PATTERNS)})"""

CANDIDATES = f"""{LINES},
candidates AS (
  SELECT doc_id, page_no, line,
    CAST(row_number() OVER (PARTITION BY doc_id, page_no ORDER BY line_no) - 1 AS INTEGER) AS line_no
  FROM lines
  WHERE length(line) >= 15 AND NOT {any_match('line', fv.EXCLUSION_PATTERNS)})"""

# word borders written out, as \b is ASCII only here
LEFT, RIGHT = r"(^|[^\pL\pN_])", r"($|[^\pL\pN_])"
MONTHS = (
    "January|February|March|April|May|June|July|August|September|October|November|December"
)
DATES = [
    rf"{LEFT}(19|20)\d{{2}}{RIGHT}",
    rf"{LEFT}\d{{1,2}}\s+({MONTHS})\s+\d{{4}}{RIGHT}",
    rf"{LEFT}\d{{1,2}}\s+[\pL\pN_]+\s+\d{{4}}{RIGHT}",
]

# pages without a native text fail and have no items
READABLE = "(doc_id * 3 + page_no) % 40 <> 0"

FOOTNOTES = rf"""{CLEAN},
note_lines AS (
  SELECT *, regexp_matches(line, '^\d{{1,3}}\s') AS opens,
    count_if(regexp_matches(line, '^\d{{1,3}}\s'))
      OVER (PARTITION BY doc_id, page_no ORDER BY line_no) AS block
  FROM clean WHERE {READABLE}),
note_blocks AS (
  SELECT doc_id, page_no, block,
    max(CASE WHEN opens THEN regexp_extract(line, '^(\d{{1,3}})', 1) END) AS number,
    max(CASE WHEN opens THEN {strip(r"regexp_replace(line, '^\d{1,3}\s+', '')")} END) AS head,
    string_agg(CASE WHEN NOT opens AND length(line) > 10 THEN ' ' || line END, '' ORDER BY line_no) AS tail
  FROM note_lines WHERE block > 0 GROUP BY doc_id, page_no, block),
footnotes AS (
  SELECT doc_id, number AS footnote_number, head || coalesce(tail, '') AS content,
    page_no AS page, block,
    least({summed('head', fv.HYBRID_CONFIDENCE_WEIGHTS)}
      + CASE WHEN length(head) > 50 THEN {dbl(0.1)} ELSE {dbl(0)} END, {dbl(1)}) AS confidence
  FROM note_blocks
  WHERE length(head) >= 10 AND NOT {any_match('head', DATES, 'i')}
    AND {any_match('head', fv.CITATION_PATTERNS)})"""

PARAGRAPHS = rf"""{FOOTNOTES},
para_lines AS (
  SELECT *, count_if(regexp_matches(line, '^\d{{1,4}}\.'))
      OVER (PARTITION BY doc_id, page_no ORDER BY line_no) AS block,
    count(*) OVER (PARTITION BY doc_id, page_no) AS page_lines
  FROM clean WHERE {READABLE}),
para_blocks AS (
  SELECT doc_id, page_no, block,
    regexp_extract(min_by(line, line_no), '^(\d+)', 1) AS number,
    {strip("string_agg(CASE WHEN line_no = start_line THEN regexp_replace(line, '^[0-9]+[.]', '') ELSE line END, ' ' ORDER BY line_no)")} AS content,
    min(line_no) AS start_line, max(line_no) + 1 AS end_line
  FROM (SELECT *, min(line_no) OVER (PARTITION BY doc_id, page_no, block) AS start_line
        FROM para_lines WHERE block > 0)
  GROUP BY doc_id, page_no, block),
para_valid AS (
  SELECT * FROM para_blocks
  WHERE length(content) >= 50
    AND ({any_contained('lower(content)', fv.PARAGRAPH_WORDS)} OR {words('content')} >= 10)),
paragraphs AS (
  SELECT doc_id, number AS paragraph_number, content, page_no AS page,
    'main_text' AS section_type, {tokens('content')} AS token_count,
    array_to_string(regexp_extract_all(content, '(\d{{1,3}})', 1), ',') AS footnote_references,
    start_line, CAST(end_line AS INTEGER) AS end_line, 'hybrid_ocr' AS extraction_method,
    {dbl(0.8)} AS confidence
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page_no, number ORDER BY block) AS nth
        FROM para_valid) WHERE nth = 1)"""

STATUS = f"""{PARAGRAPHS},
status AS (
  SELECT g.doc_id, g.page_no AS page, {READABLE.replace('doc_id', 'g.doc_id')} AS success,
    CASE WHEN NOT ({READABLE.replace('doc_id', 'g.doc_id')}) THEN 'page has no text' END AS error,
    CAST(coalesce(p.n, 0) AS INTEGER) AS paragraph_count,
    CAST(coalesce(f.n, 0) AS INTEGER) AS footnote_count
  FROM legal_pages g
  LEFT JOIN (SELECT doc_id, page, count(*) AS n FROM paragraphs GROUP BY ALL) p
    ON p.doc_id = g.doc_id AND p.page = g.page_no
  LEFT JOIN (SELECT doc_id, page, count(*) AS n FROM footnotes GROUP BY ALL) f
    ON f.doc_id = g.doc_id AND f.page = g.page_no)"""

SEMANTIC = f"""{PARAGRAPHS},
semantic_parts AS (
  SELECT doc_id, page, 0 AS kind, start_line AS place, content, 'paragraph' AS chunk_type,
    paragraph_number AS paragraph_numbers, footnote_references AS footnote_numbers, token_count,
    extraction_method, CAST(NULL AS VARCHAR) AS detection_method, confidence, section_type
  FROM paragraphs
  UNION ALL
  SELECT doc_id, page, 1, block, content, 'footnote', '', footnote_number, {tokens('content')},
    CAST(NULL AS VARCHAR), 'pymupdf', confidence, CAST(NULL AS VARCHAR)
  FROM footnotes f
  WHERE EXISTS (SELECT 1 FROM paragraphs p WHERE p.doc_id = f.doc_id AND p.page = f.page)),
semantic AS (
  SELECT doc_id,
    concat(CASE WHEN kind = 0 THEN 'para_' ELSE 'footnote_' END,
           row_number() OVER (PARTITION BY doc_id ORDER BY page, kind, place)) AS chunk_id,
    content, chunk_type, page AS page_start, page AS page_end, paragraph_numbers,
    footnote_numbers, token_count, extraction_method, detection_method, confidence, section_type
  FROM semantic_parts)"""

SECTIONS = f"""{LEGAL_PAGES},
sections AS (
  SELECT doc_id, page_no AS page,
    coalesce(last_value(marker IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY page_no
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'HEADER') AS section_type
  FROM (SELECT doc_id, page_no, CASE
    {' '.join(f"WHEN {matches('page_text', p, 'i')} THEN {lit(s)}" for s, p in fv.SECTION_PATTERNS)}
    END AS marker FROM legal_pages))"""

NOTE_OPENINGS = fv.CONSERVATIVE_FOOTNOTE_PATTERNS
CONSERVATIVE_NOTES = rf"""{CANDIDATES},
opened AS (
  SELECT doc_id, page_no, line_no, regexp_extract(line, '^(\d+)', 1) AS number,
    {strip('CASE ' + ' '.join(
        f"WHEN {matches('line', p, 'i')} THEN regexp_replace(line, {lit(p)}, '', 'i')"
        for p in NOTE_OPENINGS) + ' END')} AS content
  FROM candidates WHERE {any_match('line', NOTE_OPENINGS, 'i')}),
scored AS (
  SELECT *, least(
    {dbl(0)} + CASE WHEN {matches('content', r'ICC-\d+/\d+')} THEN {dbl(0.3)} ELSE 0 END
    + CASE WHEN {matches('content', r'[A-Z][a-z]+ v\. [A-Z]')} THEN {dbl(0.3)} ELSE 0 END
    + CASE WHEN {matches('content', r'para\.?\s+\d+', 'i')} THEN {dbl(0.2)} ELSE 0 END
    + CASE WHEN {matches('content', r'Article\s+\d+', 'i')} THEN {dbl(0.2)} ELSE 0 END
    + least(({' + '.join(f"contains(lower(content), {lit(k)})::INT" for k in fv.CONSERVATIVE_KEYWORDS)})
            * {dbl(0.1)}, {dbl(0.3)})
    + CASE WHEN length(content) < 20 THEN {dbl(-0.3)} ELSE 0 END
    + CASE WHEN {matches('content', r'(See|Cf\.)\s+')} THEN {dbl(0.1)} ELSE 0 END,
    {dbl(1)}) AS confidence
  FROM opened
  WHERE length(content) > 10 AND {any_contained('lower(content)', [w.lower() for w in fv.LEGAL_INDICATORS])}),
conservative AS (
  SELECT doc_id, concat('fn_conservative_', page_no, '_', number) AS id,
    number AS footnote_number, content, page_no AS page, confidence,
    'conservative_single_line' AS extraction_method
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page_no, number
                                     ORDER BY confidence DESC, line_no) AS nth
        FROM scored WHERE confidence >= {dbl(fv.CONSERVATIVE_MIN_CONFIDENCE)}) WHERE nth = 1)"""

BRACKETS = rf"""{SECTIONS},
bracket_all AS (
  SELECT doc_id, page_no, n, numbers[n] AS number, {strip('texts[n]')} AS raw FROM
    (SELECT doc_id, page_no, numbers, texts, unnest(range(1, len(numbers) + 1)) AS n FROM
      (SELECT doc_id, page_no,
         regexp_extract_all(page_text, '\[(\d+)\]\s*([^\[]*)', 1) AS numbers,
         regexp_extract_all(page_text, '\[(\d+)\]\s*([^\[]*)', 2) AS texts FROM legal_pages))),
brackets AS (
  SELECT b.doc_id, concat_ws('_', 'para', s.section_type, s.page, number) AS id,
    number AS paragraph_number, content, s.page,
    CAST(row_number() OVER (PARTITION BY b.doc_id, s.page ORDER BY n) - 1 AS INTEGER) AS ordinal,
    s.section_type, {tokens('content')} AS token_count
  FROM (SELECT *, {strip(r"regexp_replace(raw, '\s+', ' ', 'g')")} AS content
        FROM bracket_all WHERE length(raw) > 50) b
  JOIN sections s ON s.doc_id = b.doc_id AND s.page = b.page_no)"""


def packs(budget: int) -> str:
    """Paragraphs with their chunk number, by a walk along each section."""
    return f"""{BRACKETS},
runs AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, section_type ORDER BY page, ordinal) AS nth
  FROM brackets),
walk AS (
  SELECT doc_id, section_type, nth, token_count::BIGINT AS level, 0 AS pack FROM runs WHERE nth = 1
  UNION ALL
  SELECT r.doc_id, r.section_type, r.nth,
    CASE WHEN w.level + r.token_count > {budget} THEN r.token_count ELSE w.level + r.token_count END,
    w.pack + CASE WHEN w.level + r.token_count > {budget} THEN 1 ELSE 0 END
  FROM walk w JOIN runs r
    ON r.doc_id = w.doc_id AND r.section_type = w.section_type AND r.nth = w.nth + 1),
firsts AS (
  SELECT doc_id, section_type, max(pack) + 1 AS n_packs, min(page) AS first_page
  FROM walk JOIN runs USING (doc_id, section_type, nth) GROUP BY ALL),
offsets AS (
  SELECT doc_id, section_type, coalesce(sum(n_packs) OVER (PARTITION BY doc_id ORDER BY first_page
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM firsts),
members AS (
  SELECT r.*, printf('main_chunk_%04d', CAST(before + pack + 1 AS BIGINT)) AS chunk_id
  FROM walk JOIN runs r USING (doc_id, section_type, nth)
  JOIN offsets USING (doc_id, section_type)),
chunks AS (
  SELECT doc_id, chunk_id,
    string_agg(concat('[', paragraph_number, '] ', content), chr(10) || chr(10) ORDER BY nth) AS content,
    CAST(sum(token_count) AS BIGINT) AS token_count,
    {', '.join(f"{lit(v)} AS {k}" for k, v in fv.CHUNK_DOCUMENT.items())},
    section_type,
    array_to_string(list_transform(string_split(lower(replace(section_type, '_', ' ')), ' '),
      lambda w: upper(w[1]) || w[2:]), ' ') AS section_title,
    count(*) AS paragraph_count,
    concat(min(page), '-', max(page)) AS page_range,
    {lit(fv.CHUNK_QUALITY)} AS extraction_quality
  FROM members GROUP BY doc_id, chunk_id, section_type)"""


PACKED = packs(200)

SEARCH = f"""
chunk_texts AS (
  SELECT doc_id AS chunk_id,
    concat(CASE WHEN doc_id % 3 = 0 THEN 'Yekatom ' ELSE '' END,
           CASE WHEN doc_id % 4 = 0 THEN 'Ngaïssona ' ELSE '' END,
           CASE WHEN doc_id % 5 = 0 THEN 'war crime ' ELSE '' END,
           CASE WHEN doc_id % 7 = 0 THEN 'persecution Muslim ' ELSE '' END, text) AS content,
    CASE WHEN doc_id % 10 <> 0 THEN concat('Text in ', lang, ' from ', source,
         CASE WHEN doc_id % 6 = 0 THEN ' about Alkanto, a Christian' ELSE '' END) END AS summary,
    {pick(SEARCH_SECTIONS, 'doc_id')} AS section_type,
    concat(doc_id, '-', doc_id + 1) AS page_range
  FROM documents),
chunk_search AS (
  SELECT t.*, e.embedding FROM chunk_texts t JOIN embeddings e ON e.vec_id = t.chunk_id),
search_queries AS (
  SELECT item_id AS query_id, concat({pick(SAMPLE_QUERIES, 'item_id')}, ' ', text) AS query,
    CASE WHEN item_id % 5 <> 0 THEN 5 + item_id % 4 END AS num_results,
    CASE WHEN item_id % 3 <> 0 THEN item_id END AS conversation_id
  FROM benchmark)"""

SWAPS = [(t, v) for t, vs in fv.LEGAL_EXPANSIONS.items() for v in vs]


def name_variant(rank: int, spellings, value: str) -> str:
    return (
        f"SELECT query_id, {rank} AS rank, {value} AS query_text FROM search_queries "
        f"WHERE {any_contained('lower(query)', spellings)}"
    )


NAME_ROWS = [
    name_variant(1000 + 2 * i + j, spellings, value)
    for i, (spellings, full, name, role) in enumerate(fv.NAME_VARIANTS)
    for j, value in enumerate(
        [f"query || {lit(' ' + full)}", f"replace(query, {lit(name)}, {lit(role)})"]
    )
]

VARIANTS = f"""{SEARCH},
swaps(rank, term, variation) AS (
  VALUES {', '.join(f"({i + 1}, {lit(t)}, {lit(v)})" for i, (t, v) in enumerate(SWAPS))}),
all_variants AS (
  SELECT query_id, 0 AS rank, query AS query_text FROM search_queries
  UNION ALL
  SELECT query_id, rank, replace(lower(query), term, variation) FROM search_queries, swaps
  WHERE contains(lower(query), term)
  UNION ALL {' UNION ALL '.join(NAME_ROWS)}),
variants AS (
  SELECT * FROM (
    SELECT query_id, query_text,
      CAST(row_number() OVER (PARTITION BY query_id ORDER BY min(rank)) - 1 AS INTEGER) AS variant
    FROM all_variants GROUP BY query_id, query_text) WHERE variant < 5)"""


def topk(wanted: str, k: str) -> str:
    """Best ``k`` chunks of ``wanted(query_id, variant, ...)`` with stored vectors."""
    return f"""
pairs AS (
  SELECT w.query_id, w.variant, c.chunk_id, {k} AS k,
    list_inner_product(c.embedding::DOUBLE[], v.embedding::DOUBLE[]) AS similarity_score
  FROM {wanted} w JOIN embeddings v ON v.vec_id = (w.query_id * 7 + w.variant * 11) % (SELECT count(*) FROM embeddings),
       chunk_search c),
hits AS (
  SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id, variant
                   ORDER BY similarity_score DESC, chunk_id) AS INTEGER) AS rank FROM pairs)
  WHERE rank <= k)"""


DIMENSIONS = 1024


def bucket_counts(name: str, source: str, keys: str, text: str) -> str:
    return rf"""
{name}_counts AS (
  SELECT {keys}, CAST('0x' || substr(md5(token), 1, 7) AS BIGINT) % {DIMENSIONS} AS bucket, count(*) AS tf
  FROM (SELECT {keys}, unnest(list_filter(regexp_split_to_array(lower({text}), '\s+'), lambda x: x <> '')) AS token
        FROM {source}) GROUP BY ALL)"""


def unit_vectors(name: str, keys: str) -> str:
    """``name(keys..., embedding)``: weighted bucket counts of unit length."""
    return f"""
{name}_weights AS (
  SELECT {keys}, bucket, tf * coalesce(idf, (SELECT ln(count(*) + 1) FROM chunk_texts)) AS weight
  FROM {name}_counts LEFT JOIN idf USING (bucket)),
{name} AS (
  SELECT {keys}, list(CAST(coalesce(weight / norm, 0) AS FLOAT) ORDER BY bucket) AS embedding
  FROM (SELECT {keys}, norm, unnest(range({DIMENSIONS})) AS bucket
        FROM (SELECT {keys}, sqrt(sum(weight * weight)) AS norm FROM {name}_weights GROUP BY ALL))
  LEFT JOIN {name}_weights USING ({keys}, bucket) GROUP BY {keys})"""


def by_text(sql: str, queries: str, text: str) -> str:
    """``sql`` with vectors of texts on both sides in place of stored ones."""
    model = f"""{bucket_counts('chunk_vectors', 'chunk_texts', 'chunk_id', 'content')},
idf AS (
  SELECT bucket, ln((SELECT count(*) + 1 FROM chunk_texts) / (count(*) + 1)) AS idf
  FROM chunk_vectors_counts GROUP BY bucket),
{bucket_counts('query_vectors', queries, 'query_id, variant', text)},
{unit_vectors('chunk_vectors', 'chunk_id')},
{unit_vectors('query_vectors', 'query_id, variant')},
pairs AS ("""
    return (
        sql.replace("\npairs AS (", model, 1)
        .replace("JOIN embeddings v ON v.vec_id = (w.query_id * 7 + w.variant * 11) % (SELECT count(*) FROM embeddings)",
                 "JOIN query_vectors v ON v.query_id = w.query_id AND v.variant = w.variant")
        .replace("\n       chunk_search c)", "\n       chunk_vectors c)")
        .replace("JOIN chunk_search USING", "JOIN chunk_texts USING")
    )


def flawed(sql: str) -> str:
    """With the vectors of query 3 cut short, so that they meet none, and those of query 4 zero."""
    return sql.replace(
        "list_inner_product(c.embedding::DOUBLE[], v.embedding::DOUBLE[])",
        "CASE WHEN w.query_id = 4 THEN 0 ELSE list_inner_product(c.embedding::DOUBLE[], v.embedding::DOUBLE[]) END",
    ).replace("chunk_search c),", "chunk_search c WHERE w.query_id <> 3),")


def weight(section: str) -> str:
    cases = " ".join(
        f"WHEN {lit(s)} THEN {dbl(w)}" for s, w in fv.SECTION_WEIGHTS.items()
    )
    return f"CASE {section} {cases} ELSE {dbl(fv.DEFAULT_SECTION_WEIGHT)} END"


def counted(words_, text: str) -> str:
    return "(" + " + ".join(f"contains({text}, {lit(w.lower())})::INT" for w in words_) + ")"


def focus(words_, unit: float) -> str:
    return f"least({counted(words_, 'lower(query)')} * {dbl(unit)}, {dbl(1)})"


FOCUS = {
    "person": focus(fv.PERSONS, fv.FOCUS_UNITS["person"]),
    "legal_concept": focus(fv.FOCUS_LEGAL_TERMS, fv.FOCUS_UNITS["legal_concept"]),
    "evidence": focus(fv.FOCUS_EVIDENCE_TERMS, fv.FOCUS_UNITS["evidence"]),
    "sentence": focus(fv.FOCUS_SENTENCE_TERMS, fv.FOCUS_UNITS["sentence"]),
}


def entities(words_) -> str:
    items = ", ".join(
        f"CASE WHEN contains(lower(query), {lit(w.lower())}) THEN {lit(w)} END" for w in words_
    )
    return f"concat_ws(',', {items})"


def shared(words_, unit: float) -> str:
    both = " + ".join(
        f"CASE WHEN contains(lower(query), {lit(w.lower())}) AND contains(body, {lit(w.lower())}) "
        f"THEN {dbl(unit)} ELSE 0 END"
        for w in words_
    )
    return f"({dbl(1)} + {both})"


RELEVANCE = " * ".join(
    [
        "similarity_score",
        "section_weight",
        shared(fv.PERSONS, fv.PERSON_BOOST),
        shared(fv.CONCEPTS, fv.CONCEPT_BOOST),
    ]
    + [
        f"(CASE WHEN section_type IN ({', '.join(map(lit, sections))}) "
        f"THEN 1 + {FOCUS[name]} * {dbl(factor)} ELSE 1 END)"
        for name, sections, factor in fv.FOCUS_BOOSTS
    ]
)

BOOSTED = f"""{VARIANTS},
asked AS (
  SELECT v.query_id, v.variant, coalesce(num_results, {fv.SEARCH_DEFAULT_RESULTS}) AS n
  FROM variants v JOIN search_queries USING (query_id) WHERE variant < 3),
{topk('asked', 'w.n * 2')},
merged AS (
  SELECT query_id, chunk_id, max(similarity_score) AS similarity_score FROM hits GROUP BY ALL),
texts AS (
  SELECT m.*, q.query, coalesce(num_results, {fv.SEARCH_DEFAULT_RESULTS}) AS n,
    content, summary, section_type, page_range,
    lower(content || ' ' || coalesce(summary, '')) AS body,
    {weight('section_type')} AS section_weight
  FROM merged m JOIN chunk_search USING (chunk_id) JOIN search_queries q USING (query_id)),
boosted AS (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id
      ORDER BY relevance_score DESC, similarity_score DESC, chunk_id) AS INTEGER) AS rank
    FROM (SELECT *, {RELEVANCE} AS relevance_score FROM texts)) WHERE rank <= n)"""

RAG_BOOST = " + ".join(
    [dbl(1)]
    + [f"CASE WHEN contains(body, {lit(p.lower())}) THEN {dbl(fv.RAG_PERSON_BOOST)} ELSE 0 END" for p in fv.PERSONS]
    + [f"CASE WHEN contains(body, {lit(t)}) THEN {dbl(fv.RAG_TERM_BOOST)} ELSE 0 END" for t in fv.RAG_TERMS]
)

CONTEXTS = f"""{SEARCH},
asked AS (
  SELECT query_id, 0 AS variant, coalesce(num_results, {fv.RAG_DEFAULT_RESULTS}) AS n
  FROM search_queries),
{topk('asked', 'w.n * 2')},
texts AS (
  SELECT h.query_id, h.chunk_id, similarity_score, n, content, summary, section_type, page_range,
    lower(content || ' ' || coalesce(summary, '')) AS body
  FROM hits h JOIN chunk_search USING (chunk_id) JOIN asked USING (query_id)),
contexts AS (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id
      ORDER BY relevance_score DESC, similarity_score DESC, chunk_id) AS INTEGER) AS rank
    FROM (SELECT *, similarity_score * ({weight('section_type')}) * ({RAG_BOOST}) AS relevance_score
          FROM texts)) WHERE rank <= n),
blocks AS (
  SELECT query_id,
    string_agg(concat(chr(10), '**Source ', rank, '** - ', section_type, ' (Pages ', page_range, ')',
      chr(10), 'Relevance: ', printf('%.3f', round(relevance_score, 3)), chr(10), chr(10),
      'Content: ', content, chr(10), chr(10), 'Summary: ', coalesce(summary, ''), chr(10), '---'),
      chr(10) ORDER BY rank) AS context,
    CAST(count(*) AS INTEGER) AS num_contexts,
    string_agg(CASE WHEN rank <= {fv.MAX_SOURCES} THEN
      concat_ws('|', chunk_id, section_type, page_range, printf('%.3f', round(relevance_score, 3))) END,
      ';' ORDER BY rank) AS sources
  FROM contexts GROUP BY query_id)"""

MESSAGES = """
messages AS (
  SELECT conv_id, turn, role, text, concat(role, ': ', text) AS said FROM conversations
  WHERE role IN ('user', 'assistant'))"""

HISTORY = f"""{MESSAGES},
placed AS (
  SELECT conv_id, turn, row_number() OVER w AS position,
    CAST(coalesce(sum(length(said) + 1) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start,
    role, text
  FROM messages WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))"""

PROMPTS = f"""{CONTEXTS}, {MESSAGES},
recent AS (
  SELECT conv_id, string_agg(said, chr(10) ORDER BY turn) AS history FROM
    (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS age FROM messages)
  WHERE age <= {2 * fv.MEMORY_EXCHANGES} GROUP BY conv_id),
rag AS (
  SELECT q.query_id, q.query, q.conversation_id, coalesce(history, '') AS history,
    coalesce(context, {lit(fv.NO_CONTEXT)}) AS context,
    coalesce(num_contexts, 0) AS num_contexts, coalesce(sources, '') AS sources
  FROM search_queries q LEFT JOIN blocks USING (query_id)
  LEFT JOIN recent ON recent.conv_id = q.conversation_id)"""


def enhanced() -> str:
    steps = [(t, vs[0]) for t, vs in fv.LEGAL_EXPANSIONS.items()]
    steps += [(p.lower(), f"defendant {p}") for p in fv.PERSONS]
    sql = "SELECT query_id, lower(query) AS enhanced FROM search_queries"
    for needle, addition in steps:
        sql = (
            f"SELECT query_id, CASE WHEN contains(enhanced, {lit(needle)}) "
            f"THEN enhanced || {lit(' ' + addition)} ELSE enhanced END AS enhanced FROM ({sql})"
        )
    return sql


SYSTEM = fv.SYSTEM_PROMPT.format(**fv.PROMPT_DOCUMENT)

def summaries(limit: int) -> str:
    return rf"""{PACKED},
sentence_lists AS (
  SELECT doc_id, chunk_id, list_filter(string_split(
    regexp_replace({strip('content')}, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)),
    lambda s: s <> '') AS ss FROM chunks),
sentences AS (
  SELECT doc_id, chunk_id, i, ss[i] AS sentence, {words('ss[i]')} AS size
  FROM (SELECT *, unnest(range(1, len(ss) + 1)) AS i FROM sentence_lists)),
sentence_words AS (
  SELECT doc_id, chunk_id, i, unnest(regexp_extract_all(lower(sentence), '\pL{{4,}}')) AS word
  FROM sentences),
in_chunk AS (
  SELECT doc_id, chunk_id, word, count(*) AS frequency FROM sentence_words GROUP BY ALL),
in_table AS (
  SELECT word, CAST(round(ln(((SELECT count(*) FROM chunks) + 1) / (count(*) + 1)) * 1000000) AS BIGINT) AS weight
  FROM in_chunk GROUP BY word),
scores AS (
  SELECT doc_id, chunk_id, i, sum(frequency * weight) / count(*) AS score
  FROM sentence_words JOIN in_chunk USING (doc_id, chunk_id, word) JOIN in_table USING (word) GROUP BY ALL),
ranked AS (
  SELECT s.*, row_number() OVER w AS nth, sum(size) OVER w AS used
  FROM sentences s LEFT JOIN scores c USING (doc_id, chunk_id, i)
  WINDOW w AS (PARTITION BY s.doc_id, s.chunk_id ORDER BY coalesce(score, 0) DESC, s.i
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
summaries AS (
  SELECT doc_id, chunk_id, string_agg(CASE WHEN size > {limit} THEN
      array_to_string(regexp_extract_all(sentence, '\S+')[:{limit}], ' ') ELSE sentence END,
      ' ' ORDER BY i) AS summary
  FROM ranked WHERE nth = 1 OR used <= {limit} GROUP BY ALL)"""


SNAPSHOTS = """
snapshot_old AS (
  SELECT l.doc_id AS chunk_id, text AS content,
    CASE WHEN quality = 1 THEN 'VERDICT' ELSE 'HEADER' END AS section_type
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id),
snapshot_new AS (
  SELECT vec_id AS chunk_id, text AS content,
    CASE WHEN label >= 5 THEN 'VERDICT' ELSE 'HEADER' END AS section_type
  FROM embeddings JOIN documents d ON d.doc_id = vec_id),
changed AS (
  SELECT o.chunk_id FROM snapshot_old o JOIN snapshot_new n USING (chunk_id)
  WHERE o.content IS DISTINCT FROM n.content OR o.section_type IS DISTINCT FROM n.section_type)"""


CHANGES = """SELECT *, 'insert' AS _change_type FROM snapshot_new
  WHERE chunk_id NOT IN (SELECT chunk_id FROM snapshot_old)
UNION ALL SELECT *, 'delete' FROM snapshot_old
  WHERE chunk_id NOT IN (SELECT chunk_id FROM snapshot_new)
UNION ALL SELECT *, 'update_preimage' FROM snapshot_old WHERE chunk_id IN (SELECT chunk_id FROM changed)
UNION ALL SELECT *, 'update_postimage' FROM snapshot_new WHERE chunk_id IN (SELECT chunk_id FROM changed)"""


def with_(ctes: str, select: str) -> str:
    return f"WITH RECURSIVE {ctes}\n{select}"


def r6(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


FOOTNOTE_COLUMNS = """doc_id, footnote_number, content, page, round(confidence, 6) AS confidence,
  'pymupdf' AS detection_method, '' AS referenced_paragraphs"""

NUMERIC_RANGE = """min(CAST({0} AS BIGINT)) AS min_number, max(CAST({0} AS BIGINT)) AS max_number"""

ORACLE: dict[str, str] = {
    "page_counts": with_(LEGAL_PAGES, "SELECT doc_id, count(*) AS page_count FROM legal_pages GROUP BY doc_id"),
    "page_partitions": with_(
        LEGAL_PAGES,
        "SELECT CAST((page_no - 2) // 3 AS INTEGER) AS page_partition, count(*) AS page_count, "
        "min(page_no) AS first_page FROM legal_pages WHERE page_no > 1 GROUP BY ALL",
    ),
    "page_lines": with_(LINES, "SELECT doc_id, page_no, line_no, line FROM lines"),
    "header_footer_filter": with_(CLEAN, "SELECT doc_id, page_no, line_no, line FROM clean"),
    "exclusion_filter": with_(CANDIDATES, "SELECT doc_id, page_no, line_no, line FROM candidates"),
    "hybrid_footnotes": with_(FOOTNOTES, f"SELECT {FOOTNOTE_COLUMNS} FROM footnotes"),
    "hybrid_paragraphs": with_(PARAGRAPHS, "SELECT * FROM paragraphs"),
    "page_status": with_(STATUS, "SELECT * FROM status"),
    "run_statistics": with_(
        STATUS,
        "SELECT count(*) AS total_pages_processed, count(*) FILTER (success) AS successful_pages, "
        "count(*) FILTER (NOT success) AS failed_pages, CAST(sum(paragraph_count) AS BIGINT) AS total_paragraphs, "
        "CAST(sum(footnote_count) AS BIGINT) AS total_footnotes FROM status",
    ),
    "semantic_chunks": with_(SEMANTIC, "SELECT * REPLACE (round(confidence, 6) AS confidence) FROM semantic"),
    "saved_pages": with_(LEGAL_PAGES, "SELECT doc_id, page_no, page_text AS native_text FROM legal_pages"),
    "saved_extraction": with_(
        PARAGRAPHS,
        """SELECT doc_id, page, 'paragraph' AS kind, paragraph_number AS number, content FROM paragraphs
UNION ALL SELECT doc_id, page, 'footnote', footnote_number, content FROM footnotes""",
    ),
    "replaced_table": with_(
        PACKED,
        """SELECT doc_id, chunk_id, section_type, token_count, CAST(length(content) AS INTEGER) AS content_chars
  FROM chunks WHERE section_type <> 'HEADER'""",
    ),
    "exported_json": with_(SEMANTIC, "SELECT * REPLACE (round(confidence, 6) AS confidence) FROM semantic"),
    "exported_csv": with_(SEMANTIC, "SELECT * REPLACE (round(confidence, 6) AS confidence) FROM semantic"),
    "exported_parquet": with_(SEMANTIC, "SELECT * REPLACE (round(confidence, 6) AS confidence) FROM semantic"),
    "exported_extraction": with_(
        PARAGRAPHS,
        """SELECT doc_id, page, 'paragraph' AS kind, paragraph_number AS number, footnote_references AS mentioned
  FROM paragraphs UNION ALL SELECT doc_id, page, 'footnote', footnote_number, '' FROM footnotes""",
    ),
    "sections": with_(SECTIONS, "SELECT * FROM sections"),
    "conservative_footnotes": with_(
        CONSERVATIVE_NOTES, "SELECT * REPLACE (round(confidence, 6) AS confidence) FROM conservative"
    ),
    "bracket_paragraphs": with_(BRACKETS, "SELECT *, '' AS footnote_markers_removed FROM brackets"),
    "packed_chunks": with_(PACKED, "SELECT * FROM chunks"),
    "packed_chunks_of_cases": with_(
        PACKED,
        """SELECT c.* REPLACE (
    CASE WHEN lang <> 'en' THEN concat('Case of ', source) ELSE case_name END AS case_name,
    CASE WHEN lang <> 'en' THEN concat(source, '/', lang) ELSE case_number END AS case_number,
    CASE WHEN lang <> 'en' THEN concat('Chamber ', lang) ELSE chamber END AS chamber,
    CASE WHEN lang <> 'en' THEN '1 January 2020' ELSE date END AS date)
  FROM chunks c JOIN documents d ON d.doc_id = c.doc_id""",
    ),
    "packed_chunks_default_budget": with_(packs(fv.MAX_TOKENS_PER_CHUNK), "SELECT * FROM chunks"),
    "chunk_metadata": with_(
        PACKED,
        """SELECT doc_id, chunk_id, CAST(count(*) AS INTEGER) AS numbered_paragraphs,
  string_agg(paragraph_number, ',' ORDER BY nth) AS paragraph_numbers,
  concat(arg_min(paragraph_number, nth), '-', arg_max(paragraph_number, nth)) AS paragraph_range,
  array_to_string(list_sort(list(DISTINCT page)), ',') AS pages,
  CAST(sum(token_count) AS BIGINT) AS estimated_tokens, string_agg(id, ',' ORDER BY nth) AS paragraph_ids
FROM members GROUP BY doc_id, chunk_id""",
    ),
    "conservative_statistics": with_(
        PACKED + "," + CONSERVATIVE_NOTES[len(LEGAL_PAGES) + 1 :],
        """SELECT (SELECT count(*) FROM chunks) AS main_text_chunks,
  (SELECT count(*) FROM brackets) AS clean_paragraphs,
  (SELECT count(*) FROM conservative) AS conservative_footnotes,
  (SELECT round(coalesce(avg(confidence), 0), 6) FROM conservative) AS avg_confidence""",
    ),
    "rag_projection": with_(
        PACKED,
        "SELECT doc_id, chunk_id AS id, content AS text, case_name, case_number, section_type, "
        "page_range, token_count FROM chunks",
    ),
    "chunk_contains": with_(
        SEMANTIC, "SELECT doc_id, chunk_id, chunk_type FROM semantic WHERE contains(content, 'Chamber')"
    ),
    "extractive_summary": with_(summaries(60), "SELECT doc_id, chunk_id, summary FROM summaries"),
    "extractive_summary_long": with_(summaries(fv.SUMMARY_WORDS), "SELECT doc_id, chunk_id, summary FROM summaries"),
    "section_coverage": with_(
        PACKED,
        "SELECT section_type, count(*) AS chunk_count, round(avg(token_count), 6) AS avg_tokens, "
        "CAST(sum(token_count) AS BIGINT) AS total_tokens FROM chunks GROUP BY section_type",
    ),
    "section_distribution": with_(
        PACKED, "SELECT section_type, count(*) AS chunk_count FROM chunks GROUP BY section_type"
    ),
    "token_stats": with_(
        PACKED,
        "SELECT round(avg(token_count), 6) AS avg_tokens, min(token_count) AS min_tokens, "
        "max(token_count) AS max_tokens FROM chunks",
    ),
    "token_histogram": with_(
        PACKED,
        """SELECT count(*) FILTER (token_count <= 200) AS tokens_0_200,
  count(*) FILTER (token_count BETWEEN 201 AND 400) AS tokens_201_400,
  count(*) FILTER (token_count BETWEEN 401 AND 600) AS tokens_401_600,
  count(*) FILTER (token_count BETWEEN 601 AND 800) AS tokens_601_800,
  count(*) FILTER (token_count > 800) AS tokens_800_plus FROM chunks""",
    ),
    "distinct_paragraph_numbers": with_(
        PARAGRAPHS,
        "SELECT DISTINCT paragraph_number FROM paragraphs ORDER BY paragraph_number LIMIT 20",
    ),
    "distinct_footnote_numbers": with_(
        FOOTNOTES, "SELECT DISTINCT footnote_number FROM footnotes ORDER BY footnote_number LIMIT 20"
    ),
    "paragraphs_per_page": with_(
        PARAGRAPHS, "SELECT page, count(*) AS paragraph_count FROM paragraphs GROUP BY page"
    ),
    "number_range": with_(
        PARAGRAPHS, f"SELECT {NUMERIC_RANGE.format('paragraph_number')} FROM paragraphs"
    ),
    "footnote_number_range": with_(
        FOOTNOTES, f"SELECT {NUMERIC_RANGE.format('footnote_number')} FROM footnotes"
    ),
    "output_table_counts": with_(
        PARAGRAPHS,
        "SELECT 'paragraphs' AS table_name, count(*) AS row_count FROM paragraphs "
        "UNION ALL SELECT 'footnotes', count(*) FROM footnotes",
    ),
    "sample_rows": with_(
        PARAGRAPHS,
        "SELECT doc_id, paragraph_number, page, content FROM paragraphs "
        "ORDER BY doc_id, page, start_line LIMIT 5",
    ),
    "corpus_profile": with_(
        SEARCH,
        f"""SELECT section_type, count(*) AS chunk_count,
  round(avg({any_contained('lower(content)', [c.lower() for c in fv.CONCEPTS])}::INT), 6) AS legal_concept_density,
  {', '.join(f"count(*) FILTER (contains(content, {lit(p)})) AS person_{i}_chunks" for i, p in enumerate(fv.PERSONS))},
  round(avg(length(content)) / avg(length(summary)), 6) AS length_ratio,
  round(count(*) / (SELECT count(*) FROM chunk_texts), 6) AS chunk_share
FROM chunk_texts GROUP BY section_type""",
    ),
    "quality_report": with_(
        PACKED,
        r"""SELECT c.doc_id, chunk_count, short_chunks, empty_chunks, corrupt_chars,
  corrupt_chars > 0 AS corrupted, missing_numbers, empty_chunks / chunk_count <= 0.05 AS empty_ratio_ok
FROM (SELECT doc_id, count(*) AS chunk_count, count(*) FILTER (length(content) < 20) AS short_chunks,
        count(*) FILTER (trim(content) = '') AS empty_chunks,
        CAST(sum(len(regexp_extract_all(content, '[�\x00-\x08\x0b\x0c\x0e-\x1f]'))) AS BIGINT) AS corrupt_chars
      FROM chunks GROUP BY doc_id) c
JOIN (SELECT doc_id, max(n) - min(n) + 1 - count(DISTINCT n) AS missing_numbers
      FROM (SELECT doc_id, CAST(paragraph_number AS BIGINT) AS n FROM brackets) GROUP BY doc_id) g
  ON g.doc_id = c.doc_id""",
    ),
    "query_expansion": with_(VARIANTS, "SELECT query_id, variant, query_text FROM variants"),
    "legal_expansion_lookup": with_(
        SEARCH,
        rf"""SELECT query_id, term, CASE lower(term) {' '.join(
            f"WHEN {lit(k)} THEN {lit(','.join(v))}" for k, v in fv.LEGAL_EXPANSIONS.items())}
  ELSE '' END AS expansions
FROM (SELECT DISTINCT query_id, unnest(regexp_split_to_array(query, '\s+')) AS term FROM search_queries)""",
    ),
    "section_weights": with_(
        SEARCH, f"SELECT chunk_id, section_type, {weight('section_type')} AS section_weight FROM chunk_texts"
    ),
    "query_focus": with_(
        SEARCH,
        "SELECT query_id, "
        + ", ".join(f"round({sql}, 6) AS {name}" for name, sql in FOCUS.items())
        + " FROM search_queries",
    ),
    "query_entities": with_(
        SEARCH,
        f"""SELECT query_id, {entities(fv.PERSONS)} AS persons, {entities(fv.CONCEPTS)} AS legal_concepts,
  {entities(fv.LOCATIONS)} AS locations, {entities(fv.ACTIONS)} AS actions FROM search_queries""",
    ),
    "query_enhance": with_(SEARCH, enhanced()),
    "similarity_topk": with_(
        f"{VARIANTS}, searched AS (SELECT * FROM variants WHERE variant < 3), {topk('searched', '10')}",
        f"SELECT query_id, variant, chunk_id, {r6('similarity_score')}, rank FROM hits",
    ),
    "variant_merge": with_(
        f"{VARIANTS}, searched AS (SELECT * FROM variants WHERE variant < 3), {topk('searched', '10')}",
        "SELECT query_id, chunk_id, round(max(similarity_score), 6) AS similarity_score FROM hits GROUP BY ALL",
    ),
    "boosted_search": with_(
        BOOSTED,
        f"""SELECT query_id, rank, chunk_id, content, summary, section_type, page_range, section_weight,
  {r6('similarity_score', 'relevance_score')},
  round(CASE WHEN relevance_score <> 0 AND similarity_score > 0
        THEN relevance_score / similarity_score ELSE 1 END, 6) AS improvement_factor,
  'applied' AS data_driven_boost FROM boosted""",
    ),
    "search_metrics": with_(
        BOOSTED,
        """SELECT query_id, count(*) AS result_count, round(avg(similarity_score), 6) AS avg_similarity,
  round(avg(relevance_score), 6) AS avg_relevance,
  round((avg(relevance_score) / avg(similarity_score) - 1) * 100, 6) AS improvement_pct
FROM boosted GROUP BY query_id""",
    ),
    "text_similarity": with_(
        by_text(
            f"{SEARCH}, asked AS (SELECT item_id AS query_id, 0 AS variant, text AS query_text FROM benchmark), {topk('asked', '5')}",
            "asked",
            "query_text",
        ),
        f"SELECT query_id, variant, chunk_id, {r6('similarity_score')}, rank FROM hits",
    ),
    "text_search": with_(
        by_text(BOOSTED, "variants", "query_text"),
        f"""SELECT query_id, rank, chunk_id, summary, section_type, page_range, section_weight,
  {r6('similarity_score', 'relevance_score')},
  round(CASE WHEN relevance_score <> 0 AND similarity_score > 0
        THEN relevance_score / similarity_score ELSE 1 END, 6) AS improvement_factor,
  'applied' AS data_driven_boost FROM boosted""",
    ),
    "text_rag": with_(
        by_text(CONTEXTS, f"(SELECT query_id, 0 AS variant, enhanced FROM ({enhanced()}))", "enhanced"),
        f"""SELECT query_id, rank, chunk_id, summary, section_type, page_range,
  {r6('similarity_score', 'relevance_score')} FROM contexts""",
    ),
    "search_metrics_with_errors": with_(
        flawed(BOOSTED),
        """SELECT query_id, count(*) AS result_count, round(avg(similarity_score), 6) AS avg_similarity,
  round(avg(relevance_score), 6) AS avg_relevance,
  round((avg(relevance_score) / nullif(avg(similarity_score), 0) - 1) * 100, 6) AS improvement_pct
FROM boosted GROUP BY query_id""",
    ),
    "rag_results_with_errors": with_(
        flawed(PROMPTS),
        "SELECT query_id, num_contexts, sources, CASE WHEN num_contexts = 0 "
        "THEN 'no chunk has a vector that can be compared' END AS error FROM rag",
    ),
    "rag_retrieval": with_(
        CONTEXTS,
        f"""SELECT query_id, rank, chunk_id, content, summary, section_type, page_range,
  {r6('similarity_score', 'relevance_score')} FROM contexts""",
    ),
    "context_blocks": with_(CONTEXTS, "SELECT * FROM blocks"),
    "history_window": with_(
        MESSAGES,
        """SELECT conv_id, turn, text AS question, coalesce(history, '') AS history FROM (
  SELECT *, string_agg(said, chr(10)) OVER (PARTITION BY conv_id ORDER BY turn
    ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS history FROM messages) WHERE role = 'user'""",
    ),
    "full_history": with_(HISTORY, "SELECT conv_id, turn, position, start, role, text FROM placed"),
    "history_extents": with_(
        HISTORY,
        """SELECT conv_id, turn, text AS question, position - 1 AS history_messages, start AS history_chars
  FROM placed WHERE role = 'user'""",
    ),
    "prompt_messages": with_(
        f"{PROMPTS}, {HISTORY.removeprefix(MESSAGES).lstrip(',')}",
        f"""SELECT query_id, 0 AS position, 'system' AS role, {lit(SYSTEM)} AS text FROM search_queries
UNION ALL SELECT query_id, position, role, text
  FROM search_queries q JOIN placed p ON p.conv_id = q.conversation_id
UNION ALL SELECT q.query_id, 1 + (SELECT count(*) FROM placed p WHERE p.conv_id = q.conversation_id), 'user',
  concat({lit(fv.HUMAN_PROMPT_OPENING)}, context, {lit(fv.HUMAN_PROMPT_QUESTION)}, q.query, {lit(fv.HUMAN_PROMPT_CLOSING)})
  FROM search_queries q JOIN rag USING (query_id)""",
    ),
    "prompt_rows": with_(
        PROMPTS,
        f"""SELECT query_id, {lit(SYSTEM)} AS system, history,
  concat({lit(fv.HUMAN_PROMPT_OPENING)}, context, {lit(fv.HUMAN_PROMPT_QUESTION)}, query,
         {lit(fv.HUMAN_PROMPT_CLOSING)}) AS human FROM rag""",
    ),
    "rag_results": with_(PROMPTS, "SELECT query_id, conversation_id, num_contexts, sources FROM rag"),
    "change_feed": with_(SNAPSHOTS, CHANGES),
    "change_feed_of_snapshots": with_(SNAPSHOTS, CHANGES),
    "change_feed_new_column": with_(
        SNAPSHOTS,
        """SELECT *, CAST(NULL AS VARCHAR) AS summary,
    CASE WHEN chunk_id IN (SELECT chunk_id FROM snapshot_new) THEN 'update_preimage' ELSE 'delete' END AS _change_type
  FROM snapshot_old
UNION ALL SELECT *, concat('Section ', section_type),
    CASE WHEN chunk_id IN (SELECT chunk_id FROM snapshot_old) THEN 'update_postimage' ELSE 'insert' END
  FROM snapshot_new""",
    ),
}
