"""Patterns, word lists, weights and texts.

Everything in this file is data that decides results.  Budgets, limits, page ranges
and the header and date patterns are defaults of keyword arguments.
"""

# --- fixed values: page furniture and paragraph / footnote shapes -----------

HEADER_PATTERNS = [
    r"ICC-01/14-01/18-2784-Red\s+\d{2}-\d{2}-\d{4}\s+\d+/\d+\s+T",
    r"No\.\s+ICC-01/14-01/18\s+\d+/\d+\s+\d{2}\s+\w+\s+\d{4}",
    r"^\d+/\d+$",
    r"^No\.\s+ICC-",
]

DATE_PATTERNS = [
    r"\b(19|20)\d{2}\b",
    r"\b\d{1,2}\s+(January|February|March|April|May|June|July|August"
    r"|September|October|November|December)\s+\d{4}\b",
    r"\b\d{1,2}\s+\w+\s+\d{4}\b",
]

CITATION_PATTERNS = [
    r"P-\d+:",
    r"T-\d+",
    r"CAR-",
    r"ICC-",
    r"para\.?\s+\d+",
    r"p\.\s+\d+",
    r"lines?\s+\d+",
    r"Article\s+\d+",
    r"Rule\s+\d+",
]

# (pattern, weight) in the order in which the weights are added
HYBRID_CONFIDENCE_WEIGHTS = [
    (r"P-\d+:", 0.4),
    (r"T-\d+", 0.3),
    (r"CAR-", 0.2),
    (r"ICC-", 0.2),
    (r"para\.?\s+\d+", 0.1),
    (r"p\.\s+\d+", 0.1),
    (r"Article\s+\d+", 0.1),
    (r"Rule\s+\d+", 0.1),
]

PARAGRAPH_WORDS = ["chamber", "court", "evidence", "statute", "article"]

# --- fixed values: conservative footnotes ------------------------------------

EXCLUSION_PATTERNS = [
    r"ICC-01/14-01/18-2784-Red",
    r"\d+/1616",
    r"TRIAL CHAMBER|Appeals Chamber|Pre-Trial Chamber",
    r"Judge .+ Presiding",
    r"☒|☐",
    r"Contents|Table of Contents",
    r"Decision to be notified",
    r"SITUATION IN THE CENTRAL AFRICAN REPUBLIC",
]

CONSERVATIVE_FOOTNOTE_PATTERNS = [
    r"^\s*(\d{1,3})\s+(See\s+|Cf\.\s+|ICC-|Trial\s+Chamber|Appeals\s+Chamber"
    r"|Article\s+\d+|Rule\s+\d+)",
    r"^\s*(\d{1,3})\s+[A-Z][a-z]+\s+v\.\s+[A-Z]",
    r"^\s*(\d{1,3})\s+.*?ICC-\d+/\d+",
]

LEGAL_INDICATORS = [
    "see", "cf.", "ibid", "supra", "para", "judgment", "decision",
    "ICC-", "ICTR-", "ICTY-", "article", "rule", "statute",
]

CONSERVATIVE_KEYWORDS = [
    "judgment", "decision", "appeals", "trial chamber", "rule", "statute",
]

# --- fixed values: sections --------------------------------------------------

SECTION_PATTERNS = [
    ("OVERVIEW", r"I\.\s+OVERVIEW"),
    ("FINDINGS_OF_FACT", r"II\.\s+FINDINGS\s+OF\s+FACT"),
    ("EVIDENTIARY_CONSIDERATIONS", r"III\.\s+EVIDENTIARY\s+CONSIDERATIONS"),
    ("APPLICABLE_LAW", r"IV\.\s+APPLICABLE\s+LAW"),
    ("LEGAL_CHARACTERISATION", r"V\.\s+LEGAL\s+CHARACTERISATION"),
    ("SENTENCE", r"VI\.\s+SENTENCE"),
    ("VERDICT", r"VII\.\s+VERDICT"),
]
INITIAL_SECTION = "HEADER"

SECTION_WEIGHTS = {
    "VERDICT": 1.5,
    "SENTENCE": 1.4,
    "FINDINGS_OF_FACT": 1.3,
    "OVERVIEW": 1.1,
    "EVIDENTIARY_CONSIDERATIONS": 1.0,
    "HEADER": 0.5,
}
DEFAULT_SECTION_WEIGHT = 1.0

# --- fixed values: extraction and chunking parameters ------------------------

SKIP_FIRST_PAGES = 6
PAGES_PER_PARTITION = 50
MAX_TOKENS_PER_CHUNK = 1000
TOKENS_PER_WORD = 1.3
CONSERVATIVE_MIN_CONFIDENCE = 0.7
SUMMARY_WORDS = 200

MIN_CHUNK_LENGTH = 20
MAX_EMPTY_CHUNKS_RATIO = 0.05

# the chunk writer of the conservative path labels every chunk with these
CHUNK_DOCUMENT = {
    "case_name": "Prosecutor v. Alfred Yekatom and Patrice-Edouard Ngaïssona",
    "case_number": "ICC-01/14-01/18",
    "chamber": "Trial Chamber V",
    "date": "24 July 2025",
}
CHUNK_TYPE = "main_text_pristine"
CHUNK_QUALITY = "conservative_high_confidence"

# the prompt writer names the case in this form
PROMPT_DOCUMENT = {
    "case_name": "The Prosecutor v. Patrice-Edouard Ngaïssona and Alfred Yekatom",
    "case_number": "ICC-01/14-01/18",
}

# --- fixed values: query rewriting and boosting ------------------------------

LEGAL_EXPANSIONS = {
    "war crimes": ["war crime", "violations of the laws of war", "grave breaches"],
    "crimes against humanity": [
        "crime against humanity", "systematic attack", "widespread attack"],
    "genocide": ["genocidal acts", "intent to destroy", "ethnic cleansing"],
    "murder": ["kill", "killing", "assassination", "homicide", "unlawful killing"],
    "persecution": ["persecute", "persecuted", "discriminatory acts", "targeting"],
    "torture": ["ill-treatment", "cruel treatment", "inhuman treatment"],
    "evidentiary": ["evidence", "proof", "testimony", "witness"],
    "sentence": ["sentencing", "punishment", "penalty", "years"],
    "verdict": ["finding", "conclusion", "determination", "guilty", "not guilty"],
    "anti-balaka": ["anti balaka", "anti-balaka forces", "militia"],
    "elements": ["subordinates", "fighters", "combatants", "forces", "troops"],
    "command": ["instruct", "order", "direct", "tell", "responsibility"],
}

PERSONS = ["Yekatom", "Ngaïssona", "Alkanto"]
LOCATIONS = ["Bangui", "CAR", "Central African Republic"]
CONCEPTS = ["Muslim", "Christian", "Anti-Balaka", "war crime", "persecution"]
ACTIONS = ["kill", "murder", "instruct", "order", "attack", "target"]

# (lower-case spellings that trigger, text appended, name replaced, replacement)
NAME_VARIANTS = [
    (["yekatom"], "Alfred Yekatom", "Yekatom", "accused"),
    (["ngaïssona", "ngaissona"], "Patrice-Edouard Ngaïssona", "Ngaïssona", "co-accused"),
]

FOCUS_LEGAL_TERMS = ["war crime", "murder", "persecution", "torture", "genocide"]
FOCUS_EVIDENCE_TERMS = ["evidence", "witness", "testimony", "proof", "establish"]
FOCUS_SENTENCE_TERMS = ["sentence", "punishment", "years", "penalty", "guilty"]
FOCUS_UNITS = {"person": 0.3, "legal_concept": 0.25, "evidence": 0.2, "sentence": 0.4}

PERSON_BOOST = 0.25
CONCEPT_BOOST = 0.15
# (focus, sections it favours, factor)
FOCUS_BOOSTS = [
    ("person", ["FINDINGS_OF_FACT", "EVIDENTIARY_CONSIDERATIONS"], 0.2),
    ("sentence", ["SENTENCE"], 0.3),
    ("evidence", ["EVIDENTIARY_CONSIDERATIONS"], 0.2),
]

RAG_PERSON_BOOST = 0.15
RAG_TERM_BOOST = 0.10
RAG_TERMS = ["war crime", "murder", "persecution", "command"]

MAX_QUERY_VARIANTS = 5
SEARCHED_VARIANTS = 3
SEARCH_DEFAULT_RESULTS = 20
RAG_DEFAULT_RESULTS = 8
OVERFETCH = 2
MEMORY_EXCHANGES = 5
MAX_SOURCES = 5

# --- fixed values: prompt texts ----------------------------------------------

SYSTEM_PROMPT = """You are an expert legal analyst specializing in International Criminal Court (ICC) proceedings. You are analyzing the judgment in "{case_name}" ({case_number}).

Your expertise includes:
- International criminal law (war crimes, crimes against humanity, genocide)
- ICC procedures and legal standards
- Central African Republic conflict analysis
- Legal reasoning and evidence evaluation

Guidelines:
1. Base responses strictly on the provided judgment context
2. Use proper legal terminology and cite specific sections
3. Maintain judicial objectivity
4. Reference page numbers and sections when available
5. Clearly state when information is not available in the context

Structure your response with clear legal reasoning and specific evidence."""

HUMAN_PROMPT_OPENING = "\nContext from ICC Judgment:\n"
HUMAN_PROMPT_QUESTION = "\n\nLegal Question: "
HUMAN_PROMPT_CLOSING = (
    "\n\nPlease provide a comprehensive legal analysis based on the judgment "
    "context provided."
)
NO_CONTEXT = "No relevant context found."

# --- starts of footnotes and paragraphs ---------------------------------------

# A number and its blank at the head of a line, the blank not being the line break.
FOOTNOTE_START = r"\d{1,3}[^\S\n]"
PARAGRAPH_START = r"^\d{1,4}\."

# --- confidence of conservative footnotes: pattern, ignore case, weight --------

CONSERVATIVE_CONFIDENCE_WEIGHTS = [
    (r"ICC-\d+/\d+", False, 0.3),
    (r"[A-Z][a-z]+ v\. [A-Z]", False, 0.3),
    (r"para\.?\s+\d+", True, 0.2),
    (r"Article\s+\d+", True, 0.2),
    (r"(See|Cf\.)\s+", False, 0.1),
]
KEYWORD_WEIGHT, MAX_KEYWORD_WEIGHT = 0.1, 0.3
SHORT_FOOTNOTE_LENGTH, SHORT_FOOTNOTE_WEIGHT = 20, -0.3

# --- bands of the token histogram: name, from, to -------------------------------

TOKEN_BANDS = [
    ("tokens_0_200", None, 200),
    ("tokens_201_400", 201, 400),
    ("tokens_401_600", 401, 600),
    ("tokens_601_800", 601, 800),
    ("tokens_800_plus", 801, None),
]
