"""From raw questions to clean documents and model input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.functions import text as T


def clean_questions(questions: DataFrame) -> DataFrame:
    """``(id, title, body, code)``: HTML bodies separated into prose and code blocks."""
    return T.split_html(questions.select("id", "title", "body")).select("id", "title", "body", "code")


def model_input(clean: DataFrame, sep: str = " ", with_code: bool = False) -> DataFrame:
    code = F.col("code") if with_code else None
    return clean.select("id", T.model_text(F.col("title"), F.col("body"), code, sep).alias("text"))


def document_terms(
    texts: DataFrame, stop_words: Sequence[str] = (), bigrams: bool = False, column: str = "text"
) -> DataFrame:
    """Replace the text column by its ``terms`` array: tokens, stop words dropped, optionally neighbour pairs."""
    others = [c for c in texts.columns if c != column]
    words = texts.select(*others, T.tokens(F.col(column)).alias("terms"))
    if stop_words:
        words = words.select(*others, T.without_words(F.col("terms"), stop_words).alias("terms"))
    if bigrams:
        words = words.select(*others, T.with_bigrams(F.col("terms")).alias("terms"))
    return words


def without_stop_words(documents: DataFrame, words: DataFrame) -> DataFrame:
    """``(id, term)``, a row per kept occurrence, of ``(id, terms)`` without the ``word``s of a table of any length."""
    rows = documents.select("id", F.explode("terms").alias("term"))
    return rows.join(words, rows["term"] == words["word"], "left_anti")
