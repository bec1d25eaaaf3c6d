"""Column functions of the link side: title, body and links of one page line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The markup of a wiki dump with one page per line.
WIKI_TITLE = r"<title>(.+?)</title>"
WIKI_BODY = r"<text.*?>(.+?)</text>"
WIKI_LINK = r"\[\[(.*?)\]\]"

# The same for web pages: any line is a body and links are anchors.
HTML_BODY = r"(?s)(.+)"
HTML_LINK = r'<a href="(.*?)"'

# Where the dot of a pattern stops. Dump lines hardly ever hold one.
_DOT_STOPS = "[\n\r\u0085  ]"


def first_of(line: Column, pattern: str) -> Column:
    """Group 1 of the first match, "" without one.

    The two wiki patterns would try every opening tag, and every end of one,
    against the whole rest of a line that lacks the closing tag. They are found
    by position instead, in linear time; what the first opening tag has no
    closing tag for, no later one has.
    """
    matched = F.regexp_extract(line, pattern, 1)
    if pattern == WIKI_TITLE:
        found = _between(line, "<title>", F.lit(len("<title>")), "</title>")
    elif pattern == WIKI_BODY:
        opened = F.position(F.lit("<text"), line)
        gap = F.position(F.lit(">"), line, opened + len("<text")) - opened + 1
        found = _between(line, "<text", F.when(gap > 0, gap), "</text>")
    else:
        return matched
    return F.when(line.rlike(_DOT_STOPS), matched).otherwise(found)


def _between(line: Column, open_tag: str, tag_size: Column, close_tag: str) -> Column:
    """From ``tag_size`` behind the first ``open_tag`` up to the first ``close_tag``
    that leaves at least one character; "" if either is missing."""
    opened = F.position(F.lit(open_tag), line)
    start = opened + tag_size
    end = F.position(F.lit(close_tag), line, start + 1)
    return F.when((opened > 0) & (end > 0), F.substr(line, start, end - start)).otherwise(F.lit(""))


def links_of(body: Column, pattern: str = WIKI_LINK) -> Column:
    """Group 1 of every match, raw: no trimming, no alias cutting, empties kept.

    For wiki links the body is cut behind its last ``]]``, so that an opening
    bracket without an end does not search the rest of the body for one.
    """
    if pattern == WIKI_LINK:
        rest = F.substring_index(body, "]]", -1)
        cut = F.substr(body, F.lit(1), F.length(body) - F.length(rest))
        body = F.when(body.rlike(_DOT_STOPS), body).otherwise(cut)
    return F.regexp_extract_all(body, F.lit(pattern), 1)
