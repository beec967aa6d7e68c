"""Spark jobs for long paginated legal documents.

A table of page texts goes in; footnotes, numbered paragraphs, section labels,
token-bounded chunks, re-ranked search hits and prompt rows come out.  Every
operator takes and returns DataFrames.
"""
