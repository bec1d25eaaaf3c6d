"""Column functions of the text side: lines, tokens, weights."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed values. Java's \s is [ \t\n\x0B\f\r]; BLANK is the part of it that does
# not end a line.
BLANK = r"[ \t\x0B\f]"
LINE_END = r"(?:\r\n|\r|\n)"
QUERY_GAP = r"[ \t\n\x0B\f\r]+"

# A word edge as \b finds it on JVMs before 19: letters, decimal digits and the
# underscore are word characters, and so are the combining marks that follow a
# letter or digit.
SPELLED_OUT_EDGE = (
    r"(?:(?<=[\p{L}\p{Nd}]\p{Mn}{0,32})(?![\p{L}\p{Nd}_\p{Mn}])"
    r"|(?<=_)(?![\p{L}\p{Nd}_])"
    r"|(?<![\p{L}\p{Nd}_]|[\p{L}\p{Nd}]\p{Mn}{1,32})(?=[\p{L}\p{Nd}_]))"
)


@lru_cache(maxsize=1)
def word_edge() -> str:
    """Zero-width pattern of a word edge that sees Unicode letters.

    From JVM 19 on ``\\b`` alone knows ASCII only, so ``naïve`` would fall apart.
    """
    row = (
        SparkSession.active()
        .sql("SELECT java_method('java.lang.System', 'getProperty', 'java.specification.version')")
        .first()
    )
    version = row[0]
    before_19 = version.startswith("1.") or int(version.split(".")[0]) < 19
    return r"\b" if before_19 else SPELLED_OUT_EDGE


def token_break(edge: str) -> str:
    """What separates two tokens, over a text of any number of lines.

    Within a line, a word edge together with the blanks on both sides. Line ends
    always separate and the blanks around them stay with their own line. An edge
    takes a directly following line end along, because a zero-width match makes
    the matcher step over the next character.

    Blanks are tried from the start of their run only and never given back, so
    long runs of them cost linear time.
    """
    blanks_before = f"(?:(?<!{BLANK}){BLANK}++)?"
    return f"{blanks_before}{edge}{BLANK}*+{LINE_END}?|{LINE_END}"


def tokens_of(text: Column, edge: str | None = None) -> Column:
    """All tokens of a text, lower-cased; empty strings are still among them."""
    return F.split(F.lower(text), token_break(edge or word_edge()))


def pieces_of(text: Column, whole_up_to: int = 1 << 20) -> Column:
    """The text itself, or its lines if it is very long: token arrays of long
    texts would not fit a task, and tokens never cross lines."""
    return F.when(F.length(text) > whole_up_to, F.split(text, LINE_END)).otherwise(F.array(text))


def lines_of(text: Column) -> Column:
    """The lines a text file of this content has: the last line end adds none."""
    body = F.regexp_replace(text, LINE_END + r"\z", "")
    return F.when(text != "", F.split(body, LINE_END))


def query_terms_of(query: Column) -> Column:
    """Terms of a free-text query, repeated ones kept. Not the token rules:
    a query is cut at white space only."""
    return F.filter(F.split(F.lower(query), QUERY_GAP), lambda term: term != "")


def _folded_char(char: Column) -> Column:
    upper = F.upper(char)
    upper = F.when(F.char_length(upper) == 1, upper).otherwise(char)
    lower = F.lower(upper)
    # The one capital whose small letter, taken alone, is written with two.
    return F.when(F.char_length(lower) == 1, lower).when(upper == "\u0130", F.lit("i")).otherwise(upper)


def folded(term: Column) -> Column:
    """The form in which terms are compared without regard to case.

    Character by character through the capital to the small letter, so that
    ``ı`` meets ``i``, ``ς`` meets ``σ`` and ``ſ`` meets ``s``; a letter whose capital
    has two characters stays as it is.
    """
    chars = F.split(term, "")
    by_char = F.array_join(F.transform(chars, _folded_char), "")
    return F.when(term.rlike(r"^[\x00-\x7F]*$"), F.lower(term)).otherwise(by_char)


@lru_cache(maxsize=1)
def case_variants() -> dict[str, str]:
    """Characters that fold alike, by folded character: the small letters of which
    more than one folds to it, as a saved index may hold either."""
    spark = SparkSession.active()
    # The basic plane without surrogates; 63,488 rows in one place.
    codes = spark.range(0, 0x10000).where("id < 55296 or id > 57343")
    char = F.decode(F.unhex(F.lpad(F.hex("id"), 4, "0")), "UTF-16BE").alias("c")
    rows = codes.select(char).where(F.lower("c") == F.col("c")).select("c", folded(F.col("c")).alias("f"))
    classes = rows.groupBy("f").agg(F.array_join(F.sort_array(F.collect_list("c")), "").alias("cs"), F.count("*").alias("n"))
    return {row.f: row.cs for row in classes.where("n > 1 or cs <> f").collect()}


def log_weight(count: Column) -> Column:
    return 1 + F.log10(count)


def inverse_frequency(n_docs: Column, doc_frequency: Column) -> Column:
    """The 1 is inside the logarithm: a term found everywhere still weighs log10(2)."""
    return F.log10(1 + n_docs.cast("double") / doc_frequency)
