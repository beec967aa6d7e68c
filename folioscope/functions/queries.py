"""Query rewriting and entity detection as column expressions.

The term tables are short constants, so they are array literals in the expression:
no join with the query table.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscope import fixed_values as fv
from folioscope.functions.text import contained


def _pairs(rows: list[tuple[str, str]], *names: str) -> Column:
    return F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names)]) for row in rows])


def section_weight(section: Column) -> Column:
    weights = F.create_map(*[F.lit(v) for kv in fv.SECTION_WEIGHTS.items() for v in kv])
    return F.coalesce(F.try_element_at(weights, section), F.lit(fv.DEFAULT_SECTION_WEIGHT))


def legal_expansions(term: Column) -> Column:
    """Expansions of a term, in any case; empty if there are none."""
    table = F.create_map(
        *[
            c
            for key, values in fv.LEGAL_EXPANSIONS.items()
            for c in (F.lit(key), F.array(*map(F.lit, values)))
        ]
    )
    return F.coalesce(
        F.try_element_at(table, F.lower(term)), F.lit([]).cast("array<string>")
    )


def expand_query(query: Column, limit: int = fv.MAX_QUERY_VARIANTS) -> Column:
    """The query and its variants, first-seen order, without repeats."""
    lowered = F.lower(query)
    swaps = _pairs(
        [(term, v) for term, values in fv.LEGAL_EXPANSIONS.items() for v in values],
        "term",
        "variation",
    )
    by_term = F.transform(
        F.filter(swaps, lambda s: F.contains(lowered, s["term"])),
        lambda s: F.replace(lowered, s["term"], s["variation"]),
    )
    by_name = []
    for spellings, full_name, name, role in fv.NAME_VARIANTS:
        named = F.lit(False)
        for spelling in spellings:
            named = named | lowered.contains(spelling)
        by_name += [
            F.when(named, F.concat(query, F.lit(" " + full_name))),
            F.when(named, F.replace(query, F.lit(name), F.lit(role))),
        ]
    variants = F.concat(F.array(query), by_term, F.array_compact(F.array(*by_name)))
    return F.slice(F.array_distinct(variants), 1, limit)


def enhance_query(query: Column) -> Column:
    """Lower-cased query with one expansion per term it contains, then one addition
    per person.  Terms are tried in order on the text grown so far."""
    additions = _pairs(
        [(term, values[0]) for term, values in fv.LEGAL_EXPANSIONS.items()]
        + [(p.lower(), f"defendant {p}") for p in fv.PERSONS],
        "needle",
        "addition",
    )
    return F.aggregate(
        additions,
        F.lower(query),
        lambda text, a: F.when(
            F.contains(text, a["needle"]), F.concat(text, F.lit(" "), a["addition"])
        ).otherwise(text),
    )


def query_focus(query: Column) -> Column:
    lowered = F.lower(query)

    def weight(words: list[str], unit: float) -> Column:
        return F.least(F.size(contained(lowered, words)) * F.lit(unit), F.lit(1.0))

    units = fv.FOCUS_UNITS
    return F.struct(
        weight(fv.PERSONS, units["person"]).alias("person"),
        weight(fv.FOCUS_LEGAL_TERMS, units["legal_concept"]).alias("legal_concept"),
        weight(fv.FOCUS_EVIDENCE_TERMS, units["evidence"]).alias("evidence"),
        weight(fv.FOCUS_SENTENCE_TERMS, units["sentence"]).alias("sentence"),
    )


def query_entities(query: Column) -> Column:
    lowered = F.lower(query)
    return F.struct(
        contained(lowered, fv.PERSONS).alias("persons"),
        contained(lowered, fv.CONCEPTS).alias("legal_concepts"),
        contained(lowered, fv.LOCATIONS).alias("locations"),
        contained(lowered, fv.ACTIONS).alias("actions"),
    )


def boost_per(entities: Column, text: Column, unit: float) -> Column:
    """1 plus ``unit`` for every entity found in the text, added one by one."""
    return F.aggregate(
        entities,
        F.lit(1.0),
        lambda total, e: total
        + F.when(F.contains(text, F.lower(e)), F.lit(unit)).otherwise(F.lit(0.0)),
    )


def search_text(content: Column, summary: Column) -> Column:
    return F.lower(F.concat(content, F.lit(" "), F.coalesce(summary, F.lit(""))))


def data_driven_relevance(entities: Column, focus: Column, text: Column) -> Column:
    """Similarity times section, person, concept and focus boosts.

    ``entities`` and ``focus`` describe the query, ``text`` is the search text of the
    chunk.  Pass columns, not expressions: each is used once per entity.
    """
    section = F.col("section_type")
    score = (
        F.col("similarity_score")
        * F.col("section_weight")
        * boost_per(entities["persons"], text, fv.PERSON_BOOST)
        * boost_per(entities["legal_concepts"], text, fv.CONCEPT_BOOST)
    )
    for name, sections, factor in fv.FOCUS_BOOSTS:
        boost = F.lit(1) + focus[name] * F.lit(factor)
        score = score * F.when(section.isin(sections), boost).otherwise(F.lit(1.0))
    return score


def rag_relevance(text: Column) -> Column:
    """Similarity times section weight times one factor for persons and terms found in
    the search text of the chunk.  The query plays no part."""
    boost = F.lit(1.0)
    for words, unit in ((fv.PERSONS, fv.RAG_PERSON_BOOST), (fv.RAG_TERMS, fv.RAG_TERM_BOOST)):
        for word in words:
            hit = text.contains(word.lower())
            boost = boost + F.when(hit, F.lit(unit)).otherwise(F.lit(0.0))
    return F.col("similarity_score") * F.col("section_weight") * boost
